"""Identifiers, universes, change logs, selection, normalisers and reports on literal frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.operators import changes, entities, monitor, normalize, pit, select
from tidemark.operators.dimensions import alias_fingerprint, metric_aliases
from tidemark.sources import datasets

EARLY, LATE = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_identifier_map(spark):
    filers = spark.createDataFrame(
        [("72030", "E1", "Old", EARLY, EARLY), ("72030", "E2", "New", LATE, EARLY), ("99990", "E3", "Solo", EARLY, EARLY),
         ("bad", "E4", "x", EARLY, EARLY), ("11110", "E5", "y", "soon", EARLY)],
        "sec_code string, edinet_code string, filer_name string, known_at string, observed_at string",
    )
    listings = spark.createDataFrame(
        [("7203", "Listed", EARLY, LATE), ("130A0", "Alone", EARLY, EARLY)],
        "Code string, CoName string, known_at string, observed_at string",
    )
    got = {r.ticker: r for r in entities.identifier_map(filers, listings).collect()}
    assert set(got) == {"7203", "9999", "130A"}
    both = got["7203"]
    assert (both.edinet_code, both.company_name, both.code_match) == ("E2", "Listed", False)
    assert both.known_at == both.observed_at == datetime(2024, 2, 1)
    assert got["9999"].code_match is None and got["9999"].company_name == "Solo"
    assert entities.identifier_map(filers, listings.where("false")).count() == 2


def test_universe(spark):
    master = spark.createDataFrame(
        [("2024-01-04T00:00", "72030", "a", "01", EARLY), ("2024-01-04", "7203", "b", "01", LATE), ("2024-01-05", "130a0", "c", "02", EARLY),
         ("2024-01-05", "bad", "d", "01", EARLY), ("2024-01-05", "99990", "e", None, EARLY)],
        "Date string, Code string, CoName string, Mkt string, known_at string",
    ).withColumn("observed_at", F.lit(LATE))
    whole = entities.universe_snapshot(master)
    assert rows(whole, "date", "ticker", "company_name") == [
        ("2024-01-04", "7203", "b"), ("2024-01-05", "130A", "c"), ("2024-01-05", "9999", "e"),
    ]
    assert entities.universe_snapshot(master, allowed_markets=["01"]).count() == 1
    factors = spark.createDataFrame([("2024-01-04", "72030"), ("2024-01-05", "72030"), ("2024-01-05", "130A")], "date string, ticker string")
    assert rows(entities.filter_to_universe(factors, whole), "date", "ticker") == [("2024-01-04", "72030"), ("2024-01-05", "130A")]


def test_filing_changes(spark):
    schema = "seq_number long, doc_id string, record_sha256 string, operation_datetime string, known_at string, observed_at string"
    current = spark.createDataFrame(
        [(1, "A", "h1", None, EARLY, LATE), (2, "B", "h2", "2024-01-15 09:00", EARLY, LATE), (3, "C", "h3", "later", EARLY, LATE),
         (None, "D", "h4", None, EARLY, LATE), (5, "E", "h5", None, EARLY, LATE)], schema)
    previous = spark.createDataFrame(
        [(1, "A", "h1", None, EARLY, EARLY), (2, "B", "x", None, EARLY, EARLY), (3, "C", "x", None, EARLY, EARLY),
         (3, "C", "h3", None, EARLY, "2023-01-01"), (None, "D", "h4", None, EARLY, EARLY), (9, "gone", "h", None, EARLY, EARLY)], schema)
    assert rows(changes.filing_changes(current, previous), "doc_id", "change_type", "known_at") == [
        ("B", "revised", datetime(2024, 1, 15)), ("C", "revised", datetime(2024, 2, 1)), ("E", "new", datetime(2024, 1, 1)),
    ]
    assert changes.filing_changes(current, None).where("change_type = 'new'").count() == 5


def test_series_changes_and_rebuild(spark):
    def series(values):
        return spark.createDataFrame(
            [("s", "d", "b", "c", p, x, u, EARLY) for p, x, u in values],
            "source_id string, dataset string, db string, series_id string, period_code string, value double, source_last_update string, observed_at string",
        )

    previous = series([("1", 1.0, "u"), ("2", 2.0, "u"), ("3", None, "u"), ("4", 4.0, None)])
    current = series([("1", 1.0 + 1e-14, "u"), ("2", 2.5, "u"), ("3", float("nan"), "u"), ("4", 4.0, "w"), ("5", 5.0, "u")])
    assert rows(changes.series_changes(current, previous), "period_code", "change_type") == [("2", "revised"), ("4", "revised"), ("5", "new")]
    log = [previous.withColumn("known_at", F.lit(EARLY)), current.withColumn("known_at", F.lit(LATE))]
    at = pit.rebuild_state(log, "2024-01-15", changes.SERIES_KEY)
    assert rows(at, "period_code", "value") == [("1", 1.0), ("2", 2.0), ("3", None), ("4", 4.0)]
    assert pit.rebuild_state(log, "2024-03-01", changes.SERIES_KEY).where("period_code = '2'").first().value == 2.5


def test_record_hash_is_canonical_json(spark):
    import hashlib
    import json

    record = {"docID": "S1", "seqNumber": 3, "filerName": "日本/x", "csvFlag": None}
    text = json.dumps(record, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    row = spark.createDataFrame([("S1", 3, "日本/x", None)], "docID string, seqNumber long, filerName string, csvFlag string")
    assert row.select(changes.record_hash(list(record))).first()[0] == hashlib.sha256(text.encode()).hexdigest()


def documents(spark, listed):
    return spark.createDataFrame(listed, "doc_id string, doc_type_code string, csv_flag string, submit_datetime string, file_date string")


def test_selection(spark):
    listed = documents(spark, [
        ("A", "350", "1", "2024-01-02", "d1"), ("A", "350", "1", "2024-01-02", "d2"), ("B", "180", "1", "2024-01-01", "d1"),
        ("C", "120", "0", "2024-01-01", "d1"), ("D", "999", "1", "2024-01-01", "d1"), ("", "120", "1", "2024-01-01", "d1"),
        ("E", "120", "1", None, "d1"), ("F", "130", "1", "2024-01-03", "d1"),
    ])
    assert [r.doc_id for r in select.select_documents(listed, ordered=True).collect()] == ["E", "A", "A", "F", "B"]
    done = documents(spark, [("F", "130", "1", "x", "d")])
    chosen = select.candidates(listed, done, 2)
    assert [(r.doc_id, r.file_date) for r in chosen.collect()] == [("E", "d1"), ("A", "d2")]
    assert [r.doc_id for r in select.candidates(listed, done, 9, type_codes=v.BACKFILL_PHASES["events_buyback"]).collect()] == ["B"]


def test_pending_sources(spark):
    sources = spark.createDataFrame([("k1", "e1", 1), ("k2", "e2", 2), ("k3", None, 3), ("k4", "e4", 4), ("k5", "e5", 5), ("k6", "e6", 6)],
                                    "source_key string, source_etag string, source_size long")
    index = spark.createDataFrame(
        [("k1", "e1", 1, "ok", 5, "h"), ("k2", "old", 2, "ok", 5, "h"), ("k3", None, 3, "ok", 5, "h"), ("k4", "e4", 4, "error", 5, "h"),
         ("k5", "e5", 5, "no_matches", 4, "h")],
        "source_key string, source_etag string, source_size long, status string, alias_config_version int, alias_config_sha256 string")
    pending = select.pending_sources(sources, index, alias_version=5, alias_sha256="h", limit=4)
    assert [r.source_key for r in pending.collect()] == ["k6", "k5", "k4", "k3"]
    fingerprint = alias_fingerprint(metric_aliases(spark)).first().sha256
    assert fingerprint == alias_fingerprint(metric_aliases(spark).repartition(3)).first().sha256


FACTS = "doc_id string, doc_type_code string, element_id string, context_id string, value string, item_name string, unit string, submit_datetime string, n int"


def test_financial_metrics_and_manifest(spark):
    facts = spark.createDataFrame(
        [("A", "120", "x:Note", "c", "text", "i", "", " ", 0), ("A", "120", "x:NetSales", "c1", "△1,000", "sales", "JPY", "2024-05-01", 1),
         ("A", "120", "x:NetAssets", " ", "n/a", None, None, "2024-06-01", 2), ("B", "120", "x:Other", "c", "1", None, None, "2024-05-02", 0)], FACTS)
    aliases = metric_aliases(spark, {"revenue": ["NetSales"], "sales_twice": ["NetSales"], "net_assets": ["NetAssets"]})
    metrics = normalize.financial_metrics(facts, "run", aliases=aliases, row_order=["n"])
    assert metrics.columns == list(v.METRIC_COLUMNS)
    assert rows(metrics, "doc_id", "metric", "numeric_value", "context_id", "submit_datetime") == [
        ("A", "net_assets", None, None, "2024-05-01"), ("A", "revenue", -1000.0, "c1", "2024-05-01"), ("A", "sales_twice", -1000.0, "c1", "2024-05-01"),
    ]
    manifest = datasets.document_manifest(metrics, facts.select("doc_id").distinct())
    assert rows(manifest, "doc_id", "status", "rows", "metrics") == [
        ("A", "ok", 3, ["net_assets", "revenue", "sales_twice"]), ("B", "no_matches", 0, []),
    ]
    assert tuple(datasets.run_manifest(manifest).first()) == (1, 1, 0, 3)


def test_ownership_summary(spark):
    def fact(doc, code, element, context, value, n):
        return (doc, code, f"x:{element}", context, value, None, None, "2024-05-01", n)

    facts = spark.createDataFrame([
        fact("A", "350", "DocumentTitleCoverPage", "cover", "変更報告書", 0), fact("A", "350", "ListedOrOTC", "cover", "first", 1),
        fact("A", "350", "StockListing", "cover", "second", 2), fact("A", "350", "SecurityCodeOfIssuer", "cover", "72030", 3),
        fact("A", "350", "Name", "cover", "only a name", 4), fact("A", "350", "Name", None, "null context", 5),
        fact("A", "350", "HoldingRatioOfShareCertificatesEtc", None, "5.25%", 6), fact("A", "350", "Name", "h1", "holder", 7),
        fact("A", "350", "HoldingRatioOfShareCertificatesEtc", "h1", "0.10", 8),
        fact("A", "350", "HoldingRatioOfShareCertificatesEtcPerLastReport", "h1", "12％", 9), fact("B", "360", "Name", "c", "nobody", 0),
    ], FACTS)
    got = normalize.ownership_summary(facts, "run", row_order=["n"])
    assert got.columns == list(v.OWNERSHIP_COLUMNS)
    table = {(r.doc_id, r.holder_context_id): r for r in got.collect()}
    assert set(table) == {("A", None), ("A", "h1"), ("B", None)}
    h1 = table["A", "h1"]
    assert (h1.stock_listing, h1.issuer_stock_code, h1.is_change_report, h1.is_correction) == ("first", "7203", True, False)
    assert h1.holding_ratio_change == pytest.approx(-0.02) and h1.previous_holding_ratio_raw == "12％"
    assert h1.evidence_element_ids == sorted(["x:Name", "x:HoldingRatioOfShareCertificatesEtc", "x:HoldingRatioOfShareCertificatesEtcPerLastReport"])
    assert table["A", None].holding_ratio == 0.0525 and table["A", None].holding_ratio_change is None
    assert table["B", None].is_correction and table["B", None].evidence_element_ids == [] and table["B", None].holder_name is None


def test_reports(spark):
    listing = spark.createDataFrame([("a/b/c", 700), ("a/d", 200), ("root", 60)], "path string, length long")
    usage = {r.label: r for r in monitor.storage_usage(listing, 1000).collect()}
    assert {k: (r.bytes, r.objects) for k, r in usage.items()} == {
        "a": (900, 2), "a/b": (700, 1), "a/d": (200, 1), "(root)": (120, 2), "(total)": (960, 3)}
    assert usage["(total)"].level == "critical" and usage["a"].level is None
    runs = spark.createDataFrame([("j", "2024-01-01", "p", "error", 3), ("j", "2024-01-02", "q", "ok", 0), ("k", "2024-01-01", "p", "error", 2)],
                                 "job string, modified string, path string, status string, failed_documents int")
    assert rows(monitor.dataset_health(runs), "job", "health", "issues") == [("j", "ok", []), ("k", "attention", ["k_failures=2", "k_status_error"])]
    elements = spark.createDataFrame([("BondsIssued", "社債の発行", 3, 3, 3), ("Staff", None, 9, 9, 9), ("LoanX", None, 5, 1, 5)],
                                     "local_name string, item_name string, documents long, numeric_rows long, rows long")
    found = monitor.hint_matches(elements).where("target = 'interest_bearing_debt'")
    assert rows(found, "rank", "local_name") == [(1, "LoanX"), (2, "BondsIssued")]


def test_universe_keys_are_columns_of_the_join(spark):
    factors = spark.createDataFrame([("2024-01-04", "72030", 1.0)], "date string, ticker string, factor double")
    universe = spark.createDataFrame([("2024-01-04", "7203")], "date string, ticker string")
    joined = entities.filter_to_universe(factors, universe.hint("merge"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    (join,) = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "substring" not in join and "upper" not in join and joined.columns == factors.columns
