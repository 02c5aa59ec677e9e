"""Streams with state: any order of files gives what one batch gives, or an error; lost jobs leave no trace."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, forecast
from tidemark.plans import adapters
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import change_log, incremental, revisions


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _disclosures(spark, rows):
    """Rows of (ticker, day, number, sales, profit); the stamp is the day's."""
    full = [
        (f"{ticker}0", "2024-03-31", f"2024-01-{day:02d}", no, sales, profit, f"2024-01-{day:02d}T06:00:00Z", f"2024-02-{day:02d}T06:00:00Z")
        for ticker, day, no, sales, profit in rows
    ]
    found = spark.createDataFrame(
        full, "Code string, CurFYEn string, DiscDate string, DiscNo string, FSales double, FOP double, known_at string, observed_at string"
    )
    rest = [m for m in forecast.METRICS if m not in found.columns]
    return found.select("*", *[F.lit(None).cast("double").alias(m) for m in rest])


FILES = [
    [("1301", 1, "a", 100.0, None), ("1301", 2, "b", 110.0, 5.0), ("9999", 4, "z", 1.0, 1.0)],
    [("1301", 3, "c", None, 6.0), ("1301", 3, "d", 500.0, 1.0), ("1301", 5, "e", 99.0, None)],
    [("9999", 6, "y", 2.0, 0.5), ("7777", 1, "x", 3.0, 3.0)],
]


class Flow:
    def __init__(self, spark, folder):
        self.spark, self.paths = spark, [str(folder / n) for n in ("in", "out", "cp")]

    def feed(self, rows, per_batch=150, **options):
        source, out, checkpoint = self.paths
        arrived = _disclosures(self.spark, rows)
        arrived.coalesce(1).write.mode("append").parquet(source)
        stream = incremental.incoming_files(self.spark, source, arrived.schema, files_per_batch=per_batch)
        query = revisions.start_forecast_revisions(stream, out, checkpoint, **options)
        query.awaitTermination()
        return query

    def features(self):
        return sorted(map(str, self.spark.read.parquet(self.paths[1]).collect()))


def _in_one_batch(spark, rows):
    return sorted(map(str, forecast.forecast_revisions_with_state(_disclosures(spark, rows))[0].collect()))


@pytest.mark.parametrize("order", [(0, 1, 2), (0, 2, 1), (1, 0, 2)])
def test_files_in_any_order(spark, tmp_path, order):
    flow, late = Flow(spark, tmp_path), order[0] != 0  # both other files hold later disclosures of its keys
    if late:
        with pytest.raises(Exception, match="arrived after a later one"):
            for k in order:
                flow.feed(FILES[k])
        return
    for k in order:
        flow.feed(FILES[k])
    assert flow.features() == _in_one_batch(spark, sum(FILES, []))


def test_replay_changes_nothing_and_a_batch_costs_its_keys(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    flow.feed(FILES[0] + FILES[1])
    before, state = flow.features(), revisions.stored_state(spark, flow.paths[2]).collect()
    again = flow.feed(FILES[0] + FILES[1])
    assert flow.features() == before
    assert sorted(map(str, revisions.stored_state(spark, flow.paths[2]).collect())) == sorted(map(str, state))
    assert sum(s["numRowsUpdated"] for s in again.lastProgress["stateOperators"]) == 0
    small = flow.feed([("7777", 9, "n", 4.0, 4.0)])
    assert sum(s["numRowsUpdated"] for s in small.lastProgress["stateOperators"]) == 2  # its forecast and its stamp


def test_more_files_than_one_batch(spark, tmp_path):
    """Oldest first by default: four disclosures of one key, one file a batch."""
    flow = Flow(spark, tmp_path)
    rows = [("1301", day, str(day), 100.0 + day, 10.0 * day) for day in range(1, 5)]
    source = flow.paths[0]
    for row in rows[:3]:
        _disclosures(spark, [row]).coalesce(1).write.mode("append").parquet(source)
    flow.feed(rows[3:], per_batch=1)
    assert flow.features() == _in_one_batch(spark, rows) and len(flow.features()) == 9


def test_equal_stamps_and_skipping(spark, tmp_path):
    flow = Flow(spark, tmp_path)
    flow.feed([("1301", 2, "b", 110.0, 5.0)])
    flow.feed([("1301", 2, "c", 111.0, 5.0)])  # one batch would have taken the one before
    with pytest.raises(Exception, match="arrived after a later one"):
        flow.feed([("1301", 2, "a", 109.0, 5.0)])  # one batch would have taken this one
    skipping = Flow(spark, tmp_path / "skip")
    skipping.feed([("1301", 2, "b", 110.0, 5.0)])
    skipping.feed([("1301", 1, "a", 100.0, 5.0)], late="skip")
    assert skipping.features() == []


RECORDS = "file_date string, seq_number long, doc_id string, record_sha256 string, operation_datetime string, known_at string, observed_at string"
START = datetime(2024, 1, 1)


def _list(observed, *digests, day="d1"):
    """One list of a date as observed on a day; a missing digest is a missing record."""
    stamp = (START + timedelta(days=observed)).strftime("%Y-%m-%dT00:00:00Z")
    return [(day, k, f"D{k}", digest, None, stamp, stamp) for k, digest in enumerate(digests) if digest]


LISTS = [
    _list(1, "a", "b"),
    _list(2, "a", "c", "e") + _list(2, "x", day="d2"),
    _list(3, "a", "b", "e"),
    _list(4, "f", None, "e") + _list(4, "y", day="d2"),
]


def _log(log):
    columns = ("file_date", "seq_number", "record_sha256", "change_type", "observed_at")
    return sorted(tuple(r[c] for c in columns) for r in log.changes().collect())


def _ordered(spark):
    """The changes by comparing each list with the one before, as a batch job would."""
    out, state = [], {}
    for rows in LISTS:
        for row in rows:
            key, old = row[:3], state.get(row[:3])
            if old != row[3]:
                out.append((row[0], row[1], row[3], "new" if old is None else "revised", row[6]))
            state[key] = row[3]
    return sorted(out), state


@pytest.mark.parametrize(("order", "per_batch"), [((3, 2, 1, 0), 1), ((2, 0, 3, 1, 0), 2)])
def test_lists_in_any_order(spark, tmp_path, order, per_batch):
    source = str(tmp_path / "in")
    schema = spark.createDataFrame([], RECORDS).schema
    log = change_log.ChangeLog(spark, str(tmp_path / "log"), change_log.FILINGS, schema, buckets=4)
    for k in order:
        spark.createDataFrame(LISTS[k], RECORDS).coalesce(1).write.mode("append").parquet(source)
        if per_batch == 1:
            stream = incremental.incoming_files(spark, source, schema)
            change_log.start_change_log(stream, log, str(tmp_path / "cp")).awaitTermination()
    if per_batch > 1:
        stream = incremental.incoming_files(spark, source, schema, files_per_batch=2)
        change_log.start_change_log(stream, log, str(tmp_path / "cp")).awaitTermination()
    expected, state = _ordered(spark)
    assert _log(log) == expected
    assert {(r.file_date, r.seq_number, r.doc_id): r.record_sha256 for r in log.snapshot().collect()} == state


class Lost(Exception):
    pass


@pytest.mark.parametrize("step", ["publish", "after"])
def test_job_lost_at_each_step(spark, tmp_path, monkeypatch, step):
    source, schema = str(tmp_path / "in"), spark.createDataFrame([], RECORDS).schema
    log = change_log.ChangeLog(spark, str(tmp_path / "log"), change_log.FILINGS, schema, buckets=4)

    def work():
        stream = incremental.incoming_files(spark, source, schema)
        change_log.start_change_log(stream, log, str(tmp_path / "cp"), "r").awaitTermination()

    for k, rows in enumerate(LISTS):
        spark.createDataFrame(rows, RECORDS).coalesce(1).write.mode("append").parquet(source)
        if k == 2:
            before = _log(log)
            with monkeypatch.context() as patch:
                whole = VersionedTable.publish

                def lost(self, *args):
                    if step == "after":
                        whole(self, *args)
                    raise Lost(step)

                patch.setattr(VersionedTable, "publish", lost)
                with pytest.raises(Exception, match="Lost|publish|after"):
                    work()
            assert step == "after" or _log(log) == before
        work()
    assert _log(log) == _ordered(spark)[0]
    runs = {r.ingestion_run_id for r in log.changes().collect()}
    assert runs == {"r-0", "r-1", "r-2", "r-3"}


def test_only_touched_buckets_are_written_and_old_ones_go(spark, tmp_path):
    schema = spark.createDataFrame([], RECORDS).schema
    log = change_log.ChangeLog(spark, str(tmp_path / "log"), change_log.FILINGS, schema, buckets=16)
    many = [r for day in range(30) for r in _list(1, "a", "b", day=f"d{day}")]
    log.merge(spark.createDataFrame(many, RECORDS), "one")
    for k in range(3):
        log.merge(spark.createDataFrame(_list(2 + k, f"z{k}", day="d7"), RECORDS), "two")
    head = log.table.head()
    assert sorted(head.folders.values()).count(3) == 1 and set(head.folders.values()) == {0, 3}
    expected = _log(log)
    log.table.vacuum(keep=1)
    assert _log(log) == expected
    left = sorted(p.name for p in (tmp_path / "log" / "data" / "commit=1").glob("bucket=*"))
    assert left == [] and [p.name for p in (tmp_path / "log" / "commits").glob("0*")] == [f"{3:012d}"]
    with pytest.raises(RuntimeError, match="second writer"):
        log.table.publish(1, [0])


def test_a_bucket_lies_in_few_files(spark, tmp_path):
    """However many tasks sort the observations, a bucket is written by no more of them than it has shares."""
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    rows = [r for day in range(60) for r in _list(1, "a", "b", "c", day=f"d{day}")]
    frame = spark.createDataFrame(rows, RECORDS)
    log = change_log.ChangeLog(spark, str(tmp_path / "log"), change_log.FILINGS, frame.schema, buckets=2)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set(setting, "false")
    try:
        log.merge(frame, "one")
    finally:
        spark.conf.set(setting, before)
    assert len(_log(log)) == len(rows)
    for bucket in (tmp_path / "log" / "data" / "commit=0").glob("bucket=*"):
        assert len(list(bucket.glob("part-*"))) <= change_log.SHARES


def test_series_changes_in_any_order(spark, tmp_path):
    """Macro series: values to 12 places; the run that stored a change is on it."""
    schema = ("source_id string, dataset string, db string, series_id string, period_code string, value double, "
              "source_last_update string, known_at string, observed_at string, ingestion_run_id string")

    def seen(day, *values):
        stamp = f"2024-01-{day:02d}T00:00:00Z"
        return [("s", "d", "DB", "X", str(k), value, "20240101", stamp, stamp, "old") for k, value in enumerate(values) if value]

    responses = [seen(1, 1.0, 2.0), seen(2, 1.0 + 1e-14, 2.5, 3.0), seen(3, 1.5, 2.5, 3.0)]
    logs = []
    for order in ((0, 1, 2), (2, 0, 1)):
        log = change_log.ChangeLog(spark, str(tmp_path / str(order)), change_log.SERIES, spark.createDataFrame([], schema).schema, 2)
        for k in order:
            log.merge(spark.createDataFrame(responses[k], schema), f"run{k}")
        logs.append(sorted((r.period_code, r.change_type, r.value, r.observed_at[:10], r.ingestion_run_id) for r in log.changes().collect()))
    assert logs[0] == logs[1] == [
        ("0", "new", 1.0, "2024-01-01", "run0"), ("0", "revised", 1.5, "2024-01-03", "run2"), ("1", "new", 2.0, "2024-01-01", "run0"),
        ("1", "revised", 2.5, "2024-01-02", "run1"), ("2", "new", 3.0, "2024-01-02", "run1"),
    ]
    batch = changes.series_changes(spark.createDataFrame(responses[1], schema), spark.createDataFrame(responses[0], schema))
    assert sorted((r.period_code, r.change_type) for r in batch.collect()) == [("1", "revised"), ("2", "new")]


def test_sample_disclosures_equal_one_batch(spark, tmp_path):
    summary = adapters.forecast_summary(spark, "/root/testdata/sf0.001")
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for start, end in (("0", "1994"), ("1994", "1996"), ("1996", "9")):
        summary.where((F.col("DiscDate") >= start) & (F.col("DiscDate") < end)).write.mode("append").parquet(source)
        revisions.start_forecast_revisions(incremental.incoming_files(spark, source, summary.schema), out, checkpoint).awaitTermination()
    expected, state = forecast.forecast_revisions_with_state(summary)
    assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, expected.collect()))
    assert sorted(map(str, revisions.stored_state(spark, checkpoint).collect())) == sorted(map(str, state.collect()))
