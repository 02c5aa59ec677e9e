"""Source audit: dense brute force with exact integers on small tables."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidemark.llm import source_audit
from tidemark.llm.source_audit import audit, tokenize

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_SCHEMA = "doc_id long, text string, lang string, source string, term string, rank int"


def _lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _brute(rows: list[tuple], min_docs: int) -> list[tuple]:
    docs = [(lang or "", source or "", _TERM.findall(_lower(text or ""))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= min_docs)

        def shares(terms):
            count = Counter(t for t in terms if seen[t] >= min_docs)
            total = sum(count.values())
            return count, {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        _, whole = shares([t for _, _, terms in mine for t in terms])
        groups = {s: shares([t for _, source, terms in mine if source == s for t in terms]) for s in {d[1] for d in mine}}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        for source, (count, p) in groups.items():
            parts = {
                "pair": [(sum(gap(p[t], q[t]) for t in kept), o) for o, (_, q) in groups.items() if o != source],
                "term": [(gap(p[t], whole[t]), t) for t in kept if count[t] and p[t] > whole[t]],
            }
            for part, found in parts.items():
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[: None if part == "pair" else 10]
                out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def _rows(seed: int, count: int) -> list[tuple]:
    rng = random.Random(seed)
    words = ["Alpha", "beta", "ßeta", "ÄÖ", "中文", "x", "Y", "zed1", "a-b", "é́", "tab\tnew", "nul\0l", "K", "\u0085mid", "İ"]
    rows = []
    for i in range(count):
        text = rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(0, 30)))
        source = rng.choice(["hot", "hot", "a", "b", "Z", "ü", None])
        rows.append((i % 50, rng.choice([text, text, text, None, "", "123"]), rng.choice(["en", "en", "de", None]), source, "x", 1))
    return rows + rows[:5] + [(7, "12 34", "xx", "one", "t", 2), (8, None, "xx", "two", "t", 2), (9, "Solo", "yy", "lone", "t", 3)]


@pytest.mark.parametrize(("seed", "count", "min_docs"), [(1, 300, 10), (2, 60, 3), (3, 40, 100)])
def test_equals_dense_brute_force(spark, seed, count, min_docs):
    rows = _rows(seed, count)
    got = audit(spark.createDataFrame(rows, _SCHEMA).repartition(5), min_docs=min_docs).collect()
    assert sorted(map(tuple, got)) == _brute(rows, min_docs)


def test_tokenizer_equals_the_pattern():
    text = "".join(map(chr, range(0x250))) * 2 + "Straße—naïve’s"
    assert [t.decode() for t in tokenize(text.encode())] == _TERM.findall(_lower(text))


def test_small_memory_gives_the_same(spark):
    """Cells handed on early, and runs of one term over several batches, change no sum."""
    rows = _rows(4, 200)
    docs = spark.createDataFrame(rows, _SCHEMA)
    cells = [sorted(map(tuple, source_audit.count_terms(docs.repartition(3), held).groupBy("lang", "source", "term").sum("count", "docs").collect()))
             for held in (1, 10**6)]
    assert cells[0] == cells[1]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(tuple, audit(docs, min_docs=5).collect())) == _brute(rows, 5)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert audit(spark.createDataFrame([], _SCHEMA)).count() == 0
