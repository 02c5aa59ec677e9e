"""Exact and near deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import exact_dedup as ed
from tidemark.llm import near_dedup as nd
from tidemark.llm.components import connected_components
from tidemark.llm.storage import scratch_path
from tidemark.llm.words import shingle_sets

SCHEMA = "doc_id long, text string, digest string"


def words(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_exact_decisions(spark, frame):
    rows = [(1, "a b"), (2, "ab "), (3, " a\n b "), (4, None), (5, " \t"), (6, ""), (7, "é "), (8, "é"), (9, "x" * 300_000),
            (10, "x" * 300_000 + " "), (11, "ab\x1c"), (12, "ab"), (12, "ab"), (None, "a b   "), (None, "solo")]
    index = ed.DigestIndex(spark, scratch_path(spark, "index"), 4)
    out = ed.deduplicate(frame([(*r, "z") for r in rows], SCHEMA), index).collect()
    assert len(out) == len(rows)
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, len(t or "")))
    for key, group in groups.items():
        ids = [(-n, i) for i, n in group if i is not None]
        keep = min(ids)[1] if ids else None
        digest = hashlib.sha256(key.encode()).hexdigest()
        got = [r for r in out if r.text_sha256 == digest]
        assert len(got) == len(group)
        assert {(r.keep_id, r.group_size) for r in got} == {(keep, len(group))}
        assert all(r.kept == (r.doc_id == keep) for r in got)


def test_index_persists_and_is_bucketed(spark, frame):
    path = scratch_path(spark, "index")
    ed.deduplicate(frame([(1, "a", ""), (2, "b", "")], SCHEMA), ed.DigestIndex(spark, path, 4))
    again = ed.DigestIndex(spark, path, 4)
    out = {r.doc_id: (r.keep_id, r.kept) for r in ed.deduplicate(frame([(3, "a ", ""), (4, "c", "")], SCHEMA), again).collect()}
    assert out == {3: (1, False), 4: (4, True)}
    assert again.table().count() == 3
    plan = again.table().hint("merge").join(frame([], SCHEMA).select("digest").selectExpr("cast(digest as binary) digest"), "digest")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text
    assert ed.deduplicate(frame([], SCHEMA), again).count() == 0


def test_drop_copies_keeps_columns_and_one_row(spark, frame):
    docs = frame([(1, "a", "x"), (1, "a", "x"), (2, "a ", "y"), (3, None, "z"), (None, "n", "q")], SCHEMA)
    out = ed.drop_copies(docs, ed.DigestIndex(spark, scratch_path(spark, "index"), 4))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(2, "a ", "y"), (3, None, "z"), (None, "n", "q")], key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "C", "é"]), max_size=9).map(" ".join), max_size=6))
def test_shingle_sets(texts):
    sets, sizes = shingle_sets(texts)
    expected = []
    for t in texts:
        w = t.encode().lower().split()
        expected.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    assert sizes.tolist() == [len(s) for s in expected]
    found = np.split(sets, np.cumsum(sizes)[:-1]) if len(texts) else []
    for s, e in zip(found, expected):
        for t, f in zip(found, expected):
            assert len(np.intersect1d(s, t)) == len(e & f)


def brute(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    return components(links, ids), sets


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(1)
    rows, i = [], 0

    def add(text):
        nonlocal i
        rows.append((i * 7 % 1009, text))
        i += 1

    passage = words(rng, 60)
    for _ in range(40):  # a common passage is no near copy
        add(words(rng, 200) + " " + passage)
    for size in (2, 3, 9, 150):  # groups around the threshold, the last one larger than the neighbours' reach
        base = words(rng, 220).split()
        for k in range(size):
            copy = list(base)
            for _ in range(rng.randrange(0, 9)):
                copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
            add(" ".join(copy))
    chain = words(rng, 120).split()
    for k in range(0, 90, 3):  # each like the next, the ends unlike
        add(" ".join(chain[k:] + [f"c{j}" for j in range(k)]))
    for text in ("", None, "one two", "ONE two", "one two three", "a b c d e", "a b c d e", " \n"):
        add(text)
    add(words(rng, 30_000))
    for _ in range(60):
        add(rows[44][1])
    return rows


def test_near_duplicates_equal_brute_force(spark, frame, near_rows):
    expected, sets = brute(near_rows)
    docs = frame([(*r, "z") for r in near_rows], SCHEMA).repartition(4)
    out = {r.doc_id: r for r in nd.deduplicate(docs).collect()}
    assert len(out) == len(near_rows)
    assert {i: r.component_id for i, r in out.items()} == expected
    assert all(r.n_shingles == len(sets[i]) and r.kept == (i == expected[i]) for i, r in out.items())
    kept = nd.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_borders_between_ranges(spark, frame, near_rows):
    """Small ranges: groups are cut, and the second step joins them again."""
    expected, _ = brute(near_rows)
    docs = frame([(*r, "z") for r in near_rows], SCHEMA)
    sketches = nd.sketch(docs).where("n_shingles > 0").dropDuplicates(["set_key"])
    pairs = nd.candidates(sketches.select("doc_id", "signature"), rows_per_task=500)
    links = [tuple(r) for r in nd.confirm(pairs, docs, per_cell=20).collect()]
    found = components(links, [r.doc_id for r in sketches.collect()])
    assert all((found[a] == found[b]) == (expected[a] == expected[b]) for a in found for b in list(found)[:60])


def test_near_odd_input(frame):
    assert nd.deduplicate(frame([], SCHEMA)).count() == 0
    rows = [(1, "a b c d e f", ""), (1, "a b c d e f", ""), (None, "a b c d e f", ""), (2, None, ""), (3, "A b c d e F", "")]
    out = sorted((r.doc_id or 0, r.component_id, r.kept) for r in nd.deduplicate(frame(rows, SCHEMA)).collect())
    assert out == [(0, None, True), (1, 1, True), (1, 1, True), (2, 2, True), (3, 1, False)]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(60)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    out = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == components([x for x in links if x[0] != x[1]], nodes)


def test_edges_that_lie_together_need_no_round(spark):
    """A long path in one run of edges is one star, and stars apart are the answer."""
    path = spark.createDataFrame([(k, k + 1) for k in range(2000)], "a long, b long").coalesce(1)
    out = connected_components(path, rounds=1).collect()
    assert sorted(r.node for r in out) == list(range(2001)) and {r.component for r in out} == {0}


def rows_of_joins(spark, key, run):
    """Rows that all joins by a column made while ``run`` went."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()
    bus.waitUntilEmpty()
    listed = store.executionsList()
    last = max((listed.apply(i).executionId() for i in range(listed.size())), default=-1)
    run()
    bus.waitUntilEmpty()
    listed, made = store.executionsList(), 0
    for i in range(listed.size()):
        if (execution := listed.apply(i).executionId()) > last:
            values, nodes = store.executionMetrics(execution), store.planGraph(execution).allNodes()
            for node in (nodes.apply(k) for k in range(nodes.size())):
                if re.match(rf"\w+Join \[{key}#", node.desc()):
                    metrics = (node.metrics().apply(k) for k in range(node.metrics().size()))
                    ids = [m.accumulatorId() for m in metrics if m.name() == "number of output rows"]
                    made += sum(int(values.apply(k).replace(",", "")) for k in ids if values.contains(k))
    return made


def test_every_pair_meets_its_label_once(spark, frame):
    rng = random.Random(5)
    docs = frame([(i, words(rng, 30), "") for i in range(60)], SCHEMA)
    pairs = spark.createDataFrame([(a, b, 0.9) for a in range(60) for b in range(a + 1, 60, 7)], nd.PAIR_SCHEMA)
    assert rows_of_joins(spark, "a", lambda: nd.confirm(pairs, docs).collect()) == pairs.count()


def crowd_rows(count=2400, planted=80):
    """Texts of one source at 0.72 to each other; pairs of them share some more words, at 0.755 to 0.79."""
    rng = random.Random(7)
    head = words(rng, 160)
    rows, links = [], []
    for i in range(count):
        rows.append([i, [f"u{i}.{k}" for k in range(30)]])
    for k in range(planted):
        a, b = k, count - 1 - (k * 37) % (count // 2)
        extra = [f"p{k}.{n}" for n in range(8 + k % 5)]
        for x in (a, b):
            rows[x][1][10 : 10 + len(extra)] = extra
        links.append((a, b))
    order = list(range(count))
    rng.shuffle(order)
    return [(order[i], f"{head} {' '.join(own)}") for i, own in rows], {tuple(sorted((order[a], order[b]))) for a, b in links}


def test_planted_links_in_a_dense_region(spark, frame):
    """More alike rows than any reach, all just below the threshold, and every planted link is found."""
    rows, planted = crowd_rows()
    sets, sizes = shingle_sets([t for _, t in rows])
    shared = np.unique(sets, return_counts=True)
    some = shared[0][shared[1] > 1]
    ones = np.zeros((len(rows), len(some)), np.float32)
    row, at = np.repeat(np.arange(len(rows)), sizes), np.minimum(np.searchsorted(some, sets), len(some) - 1)
    ones[row[some[at] == sets], at[some[at] == sets]] = 1
    both = ones @ ones.T
    alike = np.triu(both / (sizes[:, None] + sizes[None] - both), 1)
    links = {tuple(sorted((rows[a][0], rows[b][0]))) for a, b in zip(*np.nonzero(alike >= 0.75))}
    assert links == planted and 0.70 < np.median(alike[alike > 0]) < 0.74
    out = nd.deduplicate(frame([(*r, "") for r in rows], SCHEMA).repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in out} == components(links, [i for i, _ in rows])


def test_candidates_of_a_dense_region(spark, frame):
    """In a region longer than the reach a row meets few neighbours; all others are left to the second pass."""
    rows, _ = crowd_rows(1200, 40)
    docs = frame([(*r, "") for r in rows], SCHEMA)
    pairs = nd.candidates(nd.sketch(docs).select("doc_id", "signature"))
    assert 0 < pairs.count() <= len(rows) * nd.TREES * 10


def test_links_by_common_shingles_only(spark, frame):
    """A source whose texts differ by words of their own: links between them share no rare shingle."""
    rng = random.Random(3)
    head = words(rng, 100).split()
    rows = []
    for i in range(900):
        text = list(head)
        for k in rng.sample(range(0, 100, 6), 0 if i % 300 == 7 else rng.choice([2, 3, 4, 5])):
            text[k] = f"u{i}.{k}"
        rows.append((i, " ".join(text)))
    docs = frame([(*r, "") for r in rows], SCHEMA)
    crowd = docs.selectExpr("doc_id", "0L as hub")
    sets = nd.crowd_shingles(crowd, docs)
    found = nd.common_links(sets.selectExpr("doc_id", "doc_id as label", "size", "common"), crowd).collect()
    expected, _ = brute(rows)
    assert components([tuple(r) for r in found], [i for i, _ in rows]) == expected
