"""Token ids, the ORC store and packing against direct encoding and brute force."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, token_store, tokens
from tidemark.llm.storage import scratch_path

DOCS = "doc_id long, text string"
TEXTS = [
    None, "", " ", "a", "The cat,  sat.\nOn  it", "x   y\n z \n", "tab\there", "été Über, «ça»...", "<|endoftext|> end", "hello <|endoftext|> world", "in<|endoftext|>side", "<|endoftext|><|endoftext|>x", "at end <|endoftext|>", "<|endoftext", 
    "don't 's 'll", "a\n\nb", "end ", "\x1c \x1c", "word " * 3000, "naïve   x", "日本 語", "a\x00 \x00b",
]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(tokens.vocabulary_path())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [tokens.END_ID]


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


LIBRARY = Tokenizer.from_file(tokens.vocabulary_path())
ENCODER = tokens.PieceEncoder(tokens.vocabulary_path(), limit=50)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*" \n\t'.,!sdtAZéß9_- \x1c語<|>", "<|endoftext|>"]), max_size=40).map("".join), max_size=4))
def test_pieces_equal_direct_encoding(texts):
    ids, sizes = ENCODER.encode(texts)
    expected = [e.ids + [2] for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert ids.tolist() == [i for row in expected for i in row]
    assert sizes.tolist() == [len(row) for row in expected]


def test_store_round_trip(spark, frame, plain):
    rows = [(i * 3 % 23, t, "x") for i, t in enumerate(TEXTS)] + [(50, "again", "x"), (50, "again", "x"), (None, "n", "x")]
    path = scratch_path(spark, "store")
    token_store.write_tokens(frame(rows, DOCS + ", shard string"), path)
    stored = token_store.read_tokens(spark, path).collect()
    assert sorted((r.doc_id is not None, r.doc_id, tuple(r.ids)) for r in stored if r.doc_id is not None) == sorted(
        (True, i, tuple(plain(t))) for i, t, _ in rows if i is not None
    )
    digests = sorted(token_store.token_digests(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in digests] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    assert [r.start for r in digests] == list(np.cumsum([0] + [r.n_tokens for r in digests[:-1]]))
    by_id = {i: t for i, t, _ in rows}
    assert all(r.ids_crc32 == crc(plain(by_id[r.doc_id])) for r in digests)
    assert [r.doc_id for r in token_store.read_tokens(spark, path, [7]).collect()] == [7]
    plan = token_store.read_tokens(spark, path, [7])._jdf.queryExecution().toString()
    assert "doc_id" in plan.split("PushedFilters")[1].split("]")[0]


def test_empty_tables(spark, frame):
    path = scratch_path(spark, "store")
    token_store.write_tokens(frame([], DOCS), path)
    assert token_store.token_digests(spark, path).count() == 0
    assert packing.pack(frame([], DOCS)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 60), max_size=8))
def test_plan_is_best_fit(histogram):
    runs = packing.plan_best_fit(histogram, 20)
    free: list[int] = []  # brute force: one piece after another
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            fits = [f for f in free if f >= length]
            if fits:
                free[free.index(min(fits))] -= length
            else:
                free.append(20 - length)
    filled = defaultdict(list)
    for r in runs:
        for k in range(r.rank_from, r.rank_to):
            q, s = divmod(k - r.rank_from, r.per_sequence)
            filled[r.first_sequence + q].append((r.first_offset + s * r.length, r.length))
    for slots in filled.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 20
    assert sorted(20 - sum(n for _, n in s) for s in filled.values()) == sorted(free)
    for length, count in histogram.items():
        covered = sorted(k for r in runs if r.length == length for k in range(r.rank_from, r.rank_to))
        assert covered == list(range(count))


def test_pack_places_every_piece(spark, frame, plain):
    rows = [(i, t) for i, t in enumerate(TEXTS)] * 2 + [(i + 100, "word " * (i * 37 % 900)) for i in range(300)]
    out = packing.pack(frame(rows, DOCS).repartition(5)).collect()
    text = dict(rows)
    pieces, slots = defaultdict(list), defaultdict(list)
    for r in out:
        ids = plain(text[r.doc_id])
        assert r.ids_crc32 == crc(ids[r.start : r.start + r.length])
        pieces[r.doc_id].append((r.piece, r.start, r.length))
        slots[r.sequence_id].append((r.offset, r.length))
    for i, t in rows:
        n = len(plain(t))
        assert sum(p[2] for p in pieces[i]) == n * (2 if i < 100 else 1)
        assert all(p[2] == 1024 for p in pieces[i] if p[0] > 0)
    for s in slots.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r.length for r in out)
    assert len(slots) <= -(-total // 1024) * 1.2 + 1
