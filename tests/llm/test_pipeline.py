"""Each stage of the pipeline against brute force on its own input, and odd tables."""

import re

import pytest

import __spark_entry__
import corpus_pipeline as cp
from tidemark.llm import decontaminate as dc
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.storage import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        before, docs = docs, materialize(stage(spark, docs, SF), name)
        out.append((name, before, docs))
    return out


def test_columns(results):
    for name, before, after in results[:-1]:
        assert after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_language_stage(results):
    _, before, after = results[0]
    lost = before.join(after.select("doc_id"), "doc_id", "left_anti").collect()
    assert not [r for r in lost if r.text and re.search(r"\w{3}", r.text)]


def test_exact_stage(results):
    _, before, after = results[1]
    best = {}
    for r in before.collect():
        key = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[key] = min(best.get(key, (1, 0)), (-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for _, i in best.values())


def test_near_stage(results):
    from test_dedup import brute

    _, before, after = results[2]
    label, _ = brute([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(label.values()))


def test_decontamination_stage(spark, results):
    _, before, after = results[3]
    items = [b" ".join(dc.plain_words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {r.doc_id for r in before.collect() if any(i in b" ".join(dc.plain_words(r.text)) for i in items)}
    kept = {r.doc_id for r in after.collect()}
    assert leaks and kept.isdisjoint(leaks) and len(kept) >= before.count() - len(leaks) - 1


def test_packing_stage(results):
    _, before, after = results[4]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}


def test_run_equals_stages(spark, results):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, cp.run(spark, SF).select(key).collect())) == sorted(map(tuple, results[-1][2].select(key).collect()))


def test_odd_tables(spark, frame, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean"
    frame([(1, "a b c d e", "x", 1)], "item_id long, text string, text2 string, doc_id long").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in ([], [(1, None, None, None, None, None), (None, "Text of some kind", "en", "s", 3, True), (2, "a b c d e", "en", None, 1, False)]):
        frame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
        out = cp.run(spark, str(tmp_path)).collect()
        assert [r.doc_id for r in out] == ([None] if rows else [])


def test_registry():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES} == set(range(1, 14))
