"""Greedy string tiling against brute force, and leaks in documents."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item_id string"
ITEMS = "item_id long, text string, doc_id string"


def brute_tiles(item, text, shortest):
    """Longest unmarked common run first, one at a time."""
    free_i, free_t, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n] and free_i[i + n] and free_t[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < shortest:
            return out
        out.append((i, j, n))
        for k in range(n):
            free_i[i + k] = free_t[j + k] = False


WORDS = st.lists(st.integers(0, 3), max_size=30)


@settings(max_examples=300, deadline=None)
@given(WORDS, WORDS)
def test_tiles_are_greedy(item, text):
    code = lambda w: dc.mix(np.asarray(w, np.uint64) + np.uint64(1))
    made = dc.tiles(code(item), code(text), 3)
    used_i, used_t = set(), set()
    for i, j, n in made:
        assert n >= 3 and item[i : i + n] == text[j : j + n]
        assert used_i.isdisjoint(range(i, i + n)) and used_t.isdisjoint(range(j, j + n))
        used_i |= set(range(i, i + n))
        used_t |= set(range(j, j + n))
    expected = brute_tiles(item, text, 3)
    # Ties between equally long matches may fall differently; the lengths in order start alike.
    assert bool(made) == bool(expected)
    if made:
        assert max(n for *_, n in made) == expected[0][2]
    left = [(i, j) for i in range(len(item) - 2) for j in range(len(text) - 2)
            if item[i : i + 3] == text[j : j + 3] and used_i.isdisjoint(range(i, i + 3)) and used_t.isdisjoint(range(j, j + 3))]
    assert not left


@given(st.lists(st.integers(0, 2**64 - 1), max_size=40), st.integers(1, 8))
def test_window_hashes(words, length):
    hashes = dc.window_hashes(np.asarray(words, np.uint64), length)
    runs = [tuple(words[i : i + length]) for i in range(len(words) - length + 1)]
    assert len(hashes) == len(runs)
    assert len(set(zip(runs, hashes.tolist()))) == len(set(runs)) == len(set(hashes.tolist()))


def text_of(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_leaks(spark, frame):
    rng = random.Random(4)
    items = [text_of(rng, n) for n in (40, 12, 5, 4, 30)]
    w = items[0].split()
    docs = {
        1: text_of(rng, 100) + " " + items[0] + " " + text_of(rng, 100),
        2: " ".join(w[20:] + ["x", "y"] + w[:20]),  # reordered
        3: " ".join(w[:10]) + " " + text_of(rng, 50),  # a quarter
        4: items[0].upper().replace(" ", ", ") + "!",
        5: items[2], 6: items[3] + " z", 7: None, 8: "", 9: text_of(rng, 20_000) + " " + items[4] + " " + items[1],
        10: " ".join(w[:26]) + " " + text_of(rng, 20),  # 65 percent
        11: text_of(rng, 300),
        12: " ".join(x for k in range(0, 40, 8) for x in w[k : k + 7] + ["q"]),  # every eighth word replaced
    }
    bench = [(k, t, "x") for k, t in enumerate(items)] + [(0, items[0], "x"), (90, None, "x"), (91, "", "x"), (None, text_of(rng, 9), "x")]
    rows = [(i, t, "clash") for i, t in docs.items()] + [(1, docs[1], "clash")]
    frames = frame(rows, SCHEMA), frame(bench, ITEMS)
    expected = sorted([(1, 0), (1, 0), (2, 0), (4, 0), (5, 2), (9, 1), (9, 4), (10, 0), (12, 0)])
    for size in (8_000_000, 200):  # one block of items, and several
        out = dc.find_leaks(*frames, block_bytes=size).collect()
        assert sorted((r.doc_id, r.item_id) for r in out) == expected
    by = {(r.doc_id, r.item_id): r for r in out}
    assert by[2, 0].coverage == 1 and by[2, 0].tiles == 2 and by[10, 0].matched_words == 26 and by[12, 0].coverage == 35 / 40
    clean = dc.drop_leaks(*frames, block_bytes=200)
    assert clean.columns == ["doc_id", "text", "item_id"]
    assert sorted(r.doc_id for r in clean.collect()) == [3, 6, 7, 8, 11]


def test_empty_tables(frame):
    some = frame([(1, "a b c d e f", "")], SCHEMA)
    assert dc.find_leaks(frame([], SCHEMA), frame([(1, "a b c d e", "")], ITEMS)).count() == 0
    assert dc.find_leaks(some, frame([], ITEMS)).count() == 0
    assert dc.drop_leaks(some, frame([], ITEMS)).count() == 1


def test_benchmark_passages_of_the_sample(spark):
    """Every document that has all words of an item in a row is found, and no document without a shared run."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, bench).collect()}
    plain = lambda t: " " + b" ".join(dc.plain_words(t)).decode() + " "
    items = [(r.item_id, plain(r.text)) for r in bench.collect()]
    whole = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in plain(d.text)}
    assert whole and whole <= found and len(found - whole) <= 2
