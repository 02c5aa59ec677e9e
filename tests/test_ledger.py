"""The incremental loop: what is done stays done, what changed is worked again, and lost runs leave no rows twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.sources.ledger import Ledger, submit_date

SCHEMA = "source_key string, metric string, value long, submit_date string"
SOURCES = "source_key string, source_etag string, source_size long"


@pytest.fixture(autouse=True)
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Work:
    """Rows from the name of a source: ``k1`` has one row, ``k2`` two, ``none`` none, ``bad`` fails."""

    def __init__(self, spark):
        self.spark, self.taken = spark, []

    def __call__(self, work):
        keys = sorted(r.source_key for r in work.collect())
        self.taken.append(keys)
        rows = [(k, f"m{i}", len(self.taken), "2024-05-10" if i else "unknown") for k in keys if k[0] == "k" for i in range(int(k[1]))]
        bad = [(k, "broken") for k in keys if k == "bad"]
        return self.spark.createDataFrame(rows, SCHEMA), self.spark.createDataFrame(bad, "source_key string, error string")


@pytest.fixture
def setting(spark, tmp_path):
    work = Work(spark)

    def ledger(sha="s1", version=5):
        return Ledger(spark, str(tmp_path / "ledger"), spark.createDataFrame([], SCHEMA).schema, version, sha)

    def listing(**etags):
        return spark.createDataFrame([(k, e, 10) for k, e in etags.items()], SOURCES)

    return work, ledger, listing


ALL = {"k1": "a", "k2": "a", "none": "a", "bad": "a"}


def _visible(ledger):
    return sorted((r.source_key, r.metric, r.value) for r in ledger.rows().collect())


def _run(ledger, sources, work, name, limit=None):
    row = ledger.run(sources, work, name, limit).collect()[0]
    return (row.processed_documents, row.skipped_documents, row.no_match_documents, row.failed_documents, row.pending_documents, row.rows_written)


def test_second_run_does_nothing_and_changes_work_again(setting):
    work, ledger, listing = setting
    assert _run(ledger(), listing(**ALL), work, "one") == (2, 0, 1, 1, 0, 3)
    assert _run(ledger(), listing(**ALL), work, "two") == (0, 3, 0, 1, 0, 0)  # the failed one is tried again
    good = {k: e for k, e in ALL.items() if k != "bad"}
    assert _run(ledger(), listing(**good), work, "three") == (0, 3, 0, 0, 0, 0) and work.taken[-1] == []
    assert _run(ledger(), listing(**{**good, "k2": "b"}), work, "four") == (1, 2, 0, 0, 0, 2)
    assert _visible(ledger()) == [("k1", "m0", 1), ("k2", "m0", 4), ("k2", "m1", 4)]
    assert _run(ledger("s2"), listing(**{**good, "k2": "b"}), work, "five") == (2, 0, 1, 0, 0, 3)
    assert _visible(ledger()) == [("k1", "m0", 5), ("k2", "m0", 5), ("k2", "m1", 5)]


def test_budget_takes_newest_first(setting):
    work, ledger, listing = setting
    sources = listing(k1="a", k2="a", k3="a", none=None)
    assert _run(ledger(), sources, work, "one", 2) == (1, 0, 1, 0, 2, 3) and work.taken[-1] == ["k3", "none"]
    # A source without an etag is worked every time, and counts against the budget.
    assert _run(ledger(), sources, work, "two", 2) == (1, 1, 1, 0, 1, 2) and work.taken[-1] == ["k2", "none"]


@pytest.mark.parametrize("step", ["data", "manifests", "index"])
def test_lost_after_each_step(setting, monkeypatch, step):
    work, ledger, listing = setting
    assert _run(ledger(), listing(k1="a"), work, "zero")[0] == 1
    sources = listing(k1="b", k2="a", none="a")
    whole = Ledger._write

    def lost(self, rows, kind, run, *partition):
        whole(self, rows, kind, run, *partition)
        if kind == step:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "_write", lost)
        with pytest.raises(RuntimeError, match="lost"):
            ledger().run(sources, work, "one")
    finished = step == "index"
    assert _visible(ledger()) == ([("k1", "m0", 2), ("k2", "m0", 2), ("k2", "m1", 2)] if finished else [("k1", "m0", 1)])
    done = step in ("manifests", "index")  # the next run enters what is noted instead of working it again
    assert _run(ledger(), sources, work, "two") == ((0, 3, 0, 0, 0, 0) if done else (2, 0, 1, 0, 0, 3))
    n = 2 if done else 3
    assert _visible(ledger()) == [("k1", "m0", n), ("k2", "m0", n), ("k2", "m1", n)]


def test_compaction_and_vacuum_change_nothing(setting, monkeypatch, tmp_path):
    work, ledger, listing = setting
    for k, etags in enumerate(({"k1": "a", "none": "a"}, {"k1": "b", "none": "a"}, {"k1": "b", "none": "a", "k2": "c"})):
        _run(ledger(), listing(**etags), work, f"r{k}")
    before, index = _visible(ledger()), sorted(map(str, ledger().index().collect()))
    with monkeypatch.context() as patch:  # lost before the old folders went
        patch.setattr("tidemark.sources.ledger.remove_path", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ledger().compact()
    assert sorted(map(str, ledger().index().collect())) == index
    ledger().compact()
    ledger().vacuum()
    assert sorted(map(str, ledger().index().collect())) == index and _visible(ledger()) == before
    assert len(list((tmp_path / "ledger" / "index").glob("run=*"))) == 1
    assert [p.name[-2:] for p in sorted((tmp_path / "ledger" / "data").glob("run=*"))] == ["r1", "r2"]
    assert _run(ledger(), listing(k1="b", none="a", k2="d"), work, "r3") == (1, 2, 0, 0, 0, 2)
    manifest = {(r.source_key, r.run[13:]): (r.status, r.rows, r.metrics, r.alias_config_version) for r in ledger().manifests().collect()}
    assert manifest["k2", "r3"] == ("ok", 2, ["m0", "m1"], 5) and manifest["none", "r0"] == ("no_matches", 0, [], 5)
    with pytest.raises(ValueError, match="run id"):
        ledger().run(listing(k1="b"), work, "a/b")


def test_submit_date(spark):
    rows = spark.createDataFrame(
        [("2024-05-10 15:00", "2024-05-11T00:00:00Z"), (" ", "2024-05-11T00:00:00Z"), (None, None)], "s string, k string")
    assert [r[0] for r in rows.select(submit_date(F.col("s"), F.col("k"))).collect()] == ["2024-05-10", "2024-05-11", "unknown"]
