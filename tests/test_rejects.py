"""What cannot be read is listed, and nothing else is lost."""

import pytest
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.operators import changes, monitor, normalize
from tidemark.plans import adapters
from tidemark.sources import catalog, documents, packages, provider, series

LISTS = "file_date string, payload string, observed_at string, source_url string"
RESPONSES = "dataset string, db string, payload string, observed_at string, source_url string, payload_sha256 string"


def test_document_lists(spark):
    bodies = [
        '{"metadata":{"status":"200"},"results":[{"seqNumber":"7","docID":"a"},{"seqNumber":8,"docID":"b"}]}',
        "{broken", '{"metadata":{"status":"404"}}', '{"metadata":{},"results":[{"seqNumber":"x"}]}', None, '{"results":[]}',
    ]
    payloads = spark.createDataFrame([(str(i), b, "2024-01-01T00:00:00Z", "u") for i, b in enumerate(bodies)], LISTS)
    read = documents.read_document_list(payloads, "run", strict=False)
    assert sorted((r.file_date, r.seq_number, r.doc_id) for r in read.collect()) == [("0", 7, "a"), ("0", 8, "b")]
    rejects = {r.file_date: r.error for r in documents.document_list_rejects(payloads).collect()}
    assert rejects == {"1": "unreadable payload", "2": "status is not 200", "3": "bad seqNumber", "4": "unreadable payload"}
    with pytest.raises(Exception, match="document list: "):
        documents.read_document_list(payloads, "run").collect()
    text, number = (documents.read_document_list(payloads.where(F.col("file_date") == "0").withColumn("payload", F.lit(
        '{"results":[{"seqNumber":%s,"docID":"a"}]}' % seq)), "run").first().record_sha256 for seq in ('"7"', "7"))
    assert text == number


def test_series_responses(spark):
    good = '{"STATUS":200,%s"RESULTSET":[{"SERIES_CODE":"A","VALUES":{"SURVEY_DATES":[202401],"VALUES":[1]}}]}'
    bodies = [good % "", good % '"NEXTPOSITION":0,', good % '"NEXTPOSITION":5,', good.replace("200", "500") % "", "nope", "{}"]
    payloads = spark.createDataFrame([(str(i), "d", b, "2024-01-01T00:00:00Z", "u", "h") for i, b in enumerate(bodies)], RESPONSES)
    rows, unequal = series.read_series(series.series_items(payloads), "run")
    assert sorted(r.dataset for r in rows.collect()) == ["0", "1"] and unequal.count() == 0
    rejects = {r.dataset: r.error for r in series.series_rejects(payloads).collect()}
    assert rejects == {"2": "more pages follow", "3": "status is not 200", "4": "unreadable payload", "5": "unreadable payload"}


def test_catalog(spark):
    bodies = ['{"GET_STATS_LIST":{"DATALIST_INF":{"TABLE_INF":{"@id":"1","T":{"$":"x","n":1}}}}}',
              '{"GET_STATS_LIST":{"DATALIST_INF":{"TABLE_INF":[{"@id":2,"U":"y"}]}}}', "<html>", '{"a":1}']
    payloads = spark.createDataFrame([(str(i), b, "2024-01-01T00:00:00Z", "h") for i, b in enumerate(bodies)],
                                     "search_term string, payload string, observed_at string, payload_sha256 string")
    schema = catalog.infer_table_schema(payloads)
    rows = catalog.flatten_tables(payloads, schema, "run").collect()
    assert {r["@id"] for r in rows} == {"1", "2"} and {r["T.$"] for r in rows} == {"x", None} and {r["U"] for r in rows} == {"y", None}
    rejects = {r.search_term: r.error for r in catalog.catalog_rejects(payloads).collect()}
    assert rejects == {"2": "unreadable payload", "3": "no catalog object"}


def test_fractions_of_a_second_stay(spark):
    frame = spark.sql("SELECT timestamp'2024-01-01 12:00:00.25' a, timestamp'2024-01-01 00:00:00' b, timestamp'2024-01-01 00:00:00.5' c")
    row = provider.stamp(frame, "bars", "2024-01-01", F.lit("2024-01-02T00:00:00Z")).first()
    assert (row.a, row.b, row.c) == ("2024-01-01 12:00:00.250000", "2024-01-01", "2024-01-01 00:00:00.500000")


def test_payload_that_returns_is_kept_again(spark):
    from hashlib import sha256

    kept = spark.createDataFrame([("m", sha256(v.encode()).hexdigest(), i) for i, v in enumerate(["v1", "v2"])], "manifest_id string, sha256 string, nth int")
    now = spark.createDataFrame([("m", "v1"), ("n", "v1")], "manifest_id string, payload string")
    assert changes.changed_payloads(now, kept, newest="nth").count() == 2
    assert changes.changed_payloads(now.withColumn("payload", F.lit("v2")), kept, newest="nth").count() == 1


def test_padded_alias_is_matched(spark):
    facts = spark.createDataFrame([("d", "jp:NetSales ", "i", "u", "c", "1"), ("d", " jp:Odd", "i", "u", "c", "1")],
                                  "doc_id string, element_id string, item_name string, unit string, context_id string, value string")
    assert [r.local_name for r in monitor.unmatched_elements(facts).collect()] == ["Odd"]


def test_fact_members():
    yes = ["XBRL_TO_CSV/a.csv", "p\\xbrl_to_csv\\B.CSV"]
    assert all(map(packages.is_fact_member, yes))
    assert not any(map(packages.is_fact_member, ["a.csv", "xbrl_to_csv/a.xml", "xbrl_to_csv/"]))


def test_codes_are_one_to_one(spark):
    keys = [*range(0, 10_000, 97), *range(10_000, 100_000, 991), *range(100_000, 1_200_000, 9973)]
    codes = [r.c for r in spark.createDataFrame([(k,) for k in keys], "k long").select(adapters.security("k").alias("c")).collect()]
    assert len(set(codes)) == len(keys) and {len(c) for c in codes} == {4}
    with pytest.raises(Exception, match="no code left"):
        spark.range(10**7, 10**7 + 1).select(adapters.security("id")).collect()
    assert [r.p for r in spark.createDataFrame([(7,), (123456,)], "k long").select(adapters.padded("k", 4).alias("p")).collect()] == ["0007", "123456"]


def test_facts_without_a_document(spark):
    """Facts without a doc_id and packages without a list row are listed; valid and rejected rows are the input."""
    rows = [("a", "x:NetSales", "1"), (None, "x:NetSales", "2"), (None, "x:Other", None), ("b", "x:NetSales", "3")]
    facts = spark.createDataFrame(rows, "doc_id string, element_id string, value string").withColumns(
        {"context_id": F.lit("c"), "doc_type_code": F.lit("350")})
    valid, rejected = normalize.split_facts(facts)
    assert sorted(r.value or "" for r in rejected.collect()) == ["", "2"] and {r.error for r in rejected.collect()} == {"no doc_id"}
    assert valid.count() + rejected.count() == facts.count()
    aliases = spark.createDataFrame([("NetSales", "net_sales")], "local_name string, metric string")
    assert sorted(r.doc_id for r in normalize.financial_metrics(facts, "run", aliases=aliases).collect()) == ["a", "b"]
    assert sorted(r.doc_id for r in normalize.ownership_summary(facts, "run").collect()) == ["a", "b"]


def test_packages_without_a_list_row(spark):
    columns = ["path", "package_sha256", "csv_file_name", "csv_sha256", "error", *v.FACT_COLUMNS]
    paths = [("in/A.zip", None), ("in/B.zip", None), ("in/A.zip", None), ("in/C.zip", "not a ZIP"), ("in/odd", None)]
    rows = spark.createDataFrame([(p, "h", "f", "s", e, *["x"] * len(v.FACT_COLUMNS)) for p, e in paths],
                                 ", ".join(f"{c} string" for c in columns)).withColumn("row_number", F.lit(0).cast("long"))
    names = ["category", "doc_type_code", "doc_description", "edinet_code", "sec_code", "filer_name", "issuer_edinet_code",
             "subject_edinet_code", "parent_doc_id", "period_start", "period_end", "submit_datetime", "operation_datetime", "source_url"]
    listed = spark.createDataFrame([("A",), ("C",)], "doc_id string").withColumns({n: F.lit(None).cast("string") for n in names})
    listed = listed.withColumn("observed_at", F.lit("2024-01-01T00:00:00Z"))
    valid, rejected = packages.package_facts(rows, listed, "run"), packages.package_rejects(rows, listed)
    assert [r.doc_id for r in valid.collect()] == ["A", "A"]
    assert sorted((r.path, r.error) for r in rejected.collect()) == [
        ("in/B.zip", "no list row"), ("in/C.zip", "not a ZIP"), ("in/odd", "no list row")]
    assert valid.count() + rejected.count() == rows.count()
