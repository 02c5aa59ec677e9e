"""Landed payloads, packages, sinks and streams, in temporary folders."""

import io
import json
import zipfile
from datetime import datetime

import pyarrow as pa
import pyarrow.csv
import pytest
from pyspark.sql import functions as F

from tidemark.sources import catalog, datasets, documents, packages, provider, series, versioned
from tidemark.streaming import incremental

STAMP = "2024-05-10T06:00:00Z"
HEADER = ["要素ID", "項目名", "コンテキストID", "相対年度", "連結・個別", "期間・時点", "ユニットID", "単位", "値"]


def package(path, members, encoding="utf-16"):
    with zipfile.ZipFile(path, "w") as archive:
        for name, lines in members.items():
            archive.writestr(name, "\n".join("\t".join(cells) for cells in lines).encode(encoding))


def test_packages(spark, tmp_path):
    fact = ["jp:NetSales", "売上高", "Current", "当期", "連結", "期間", "JPY", "円", "1,000"]
    package(tmp_path / "S1.zip", {
        "XBRL_TO_CSV/a.csv": [HEADER, fact, fact], "XBRL_TO_CSV\\b.CSV": [["Element ID", "Context ID", "Value"], ["x:Y", "c", "2"]],
        "other/skip.csv": [["no"]],
    })
    package(tmp_path / "S2.zip", {"XBRL_TO_CSV/a.csv": [HEADER, fact], "XBRL_TO_CSV/b.csv": [["Element ID", "Value"], ["x", "1"]]})
    package(tmp_path / "S3.zip", {"readme.txt": [["x"]]})
    (tmp_path / "S4.zip").write_bytes(b"not a zip")
    rows = packages.unpack_packages(spark, str(tmp_path)).persist()
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in rows.where("error IS NOT NULL").collect()}
    assert set(errors) == {"S2.zip", "S3.zip", "S4.zip"} and "context_id" in errors["S2.zip"]
    listed = spark.createDataFrame(
        [("S1", "120", "financial", "72030", "2024-05-10 15:00", None, STAMP)],
        "doc_id string, doc_type_code string, category string, sec_code string, submit_datetime string, operation_datetime string, observed_at string",
    ).withColumns({c: F.lit(None).cast("string") for c in (
        "doc_description", "edinet_code", "filer_name", "issuer_edinet_code", "subject_edinet_code", "parent_doc_id", "period_start",
        "period_end", "source_url")})
    facts = packages.package_facts(rows, listed, "run").orderBy("csv_file_name", "row_number").collect()
    assert [(r.element_id, r.value, r.item_name) for r in facts] == [("jp:NetSales", "1,000", "売上高")] * 2 + [("x:Y", "2", "")]
    assert facts[0].stock_code == "7203" and facts[0].known_at == datetime(2024, 5, 10, 6)
    rows.unpersist()


def test_unzipped_text(spark, tmp_path):
    text = "\n".join("\t".join(c) for c in [HEADER, ["jp:A", "名", "c", "", "", "", "", "", "7"]])
    (tmp_path / "f.csv").write_bytes(text.encode("utf-16"))
    row = packages.read_fact_text(spark, str(tmp_path)).first()
    assert (row.element_id, row.item_name, row.unit, row.value) == ("jp:A", "名", "", "7")


def test_series(spark, tmp_path):
    body = {"STATUS": 200, "RESULTSET": [
        {"SERIES_CODE": "A", "LAST_UPDATE": 20240105, "VALUES": {"SURVEY_DATES": [202401, 202402, 202403], "VALUES": [1.5, "NA", None]}},
        {"SERIES_CODE": "B", "LAST_UPDATE": "", "VALUES": {"SURVEY_DATES": ["2024Q1"], "VALUES": ["x"]}},
        {"SERIES_CODE": "C", "VALUES": {"SURVEY_DATES": ["1", "2"], "VALUES": ["1"]}}, {"SERIES_CODE": "D"}]}
    (tmp_path / "r.json").write_text(json.dumps(body))
    payloads = datasets.read_payloads(spark, str(tmp_path)).withColumns(
        {"dataset": F.lit("d"), "db": F.lit("b"), "observed_at": F.lit(STAMP), "source_url": F.lit("u")})
    observations, rejected = series.read_series(series.series_items(payloads), "run")
    got = [(r.series_id, r.period_code, r.value, r.known_at) for r in observations.orderBy("series_id", "period_code").collect()]
    update, seen = datetime(2024, 1, 5, 14, 59, 59), datetime(2024, 5, 10, 6)
    assert got == [("A", "202401", 1.5, update), ("A", "202402", None, update), ("A", "202403", None, update), ("B", "2024Q1", None, seen)]
    assert [r["item"]["SERIES_CODE"] for r in rejected.collect()] == ["C"]


def test_catalog(spark):
    def body(tables):
        return json.dumps({"GET_STATS_LIST": {"DATALIST_INF": {"TABLE_INF": tables}}})

    payloads = spark.createDataFrame(
        [("t1", body({"@id": "1", "T": {"$": "x"}})), ("t2", body([{"@id": "2", "N": 5}, {"@id": "3"}])), ("t3", body([])), ("t4", "{}")],
        "search_term string, payload string").withColumns({"observed_at": F.lit(STAMP), "payload_sha256": F.lit("h")})
    schema = catalog.infer_table_schema(payloads)
    got = catalog.flatten_tables(payloads, schema, "run").orderBy("`@id`").collect()
    assert [(r.search_term, r["@id"], r["T.$"], r["N"]) for r in got] == [("t1", "1", "x", None), ("t2", "2", None, "5"), ("t2", "3", None, None)]


def test_document_list(spark):
    good = json.dumps({"metadata": {"status": "200"}, "results": [{"seqNumber": 1, "docID": "S1", "secCode": "72030", "submitDateTime": "2024-05-10 09:00"},
                                                                  {"seqNumber": 2, "docID": "S2", "secCode": "12"}]})
    bad = json.dumps({"metadata": {"status": "404", "message": "no"}})
    payloads = spark.createDataFrame([("d1", good), ("d2", bad)], "file_date string, payload string").withColumns(
        {"observed_at": F.lit(STAMP), "source_url": F.lit("u")})
    got = documents.read_document_list(payloads, "run", strict=False).orderBy("seq_number").collect()
    assert [(r.doc_id, r.stock_code, r.known_at) for r in got] == [("S1", "7203", datetime(2024, 5, 10)), ("S2", None, datetime(2024, 5, 10, 6))]
    assert len(got[0]) == 40 and got[0].record_sha256 != got[1].record_sha256
    with pytest.raises(Exception, match="document list: "):
        documents.read_document_list(payloads, "run").collect()


def test_stamp(spark):
    frame = spark.sql("SELECT DATE '2024-05-10' DiscDate, '15:30' DiscTime, TIMESTAMP '2024-05-10' At")
    row = provider.stamp(frame, "financial_summary", "2024-05-12", F.lit(STAMP)).first()
    assert (row.DiscDate, row.At, row.known_at) == ("2024-05-10", "2024-05-10", datetime(2024, 5, 10, 6, 30))
    row = provider.stamp(frame, "daily_bars", "2024-05-12", F.lit(STAMP)).first()
    assert (row.known_at, row.observed_at) == (datetime(2024, 5, 12, 14, 59, 59), datetime(2024, 5, 10, 6))


def test_partitioned_write_and_replace(spark, tmp_path):
    root = str(tmp_path / "t")

    def table(rows):
        return spark.createDataFrame(rows, "doc_id string, x int, day string")

    datasets.write_dataset(table([("A", 1, "d1"), ("B", 2, "d2")]), root, ["day"])
    datasets.write_dataset(table([("C", 3, "d2")]), root, ["day"])
    assert sorted(r.doc_id for r in datasets.read_dataset(spark, root).collect()) == ["A", "C"]
    assert datasets.source_listing(spark, root).count() >= 2


@pytest.mark.parametrize("step", ["stage", "publish"])
def test_documents_are_replaced_whole_or_not_at_all(spark, tmp_path, monkeypatch, step):
    def table(rows):
        return spark.createDataFrame(rows, "doc_id string, x int")

    stored = versioned.VersionedTable(spark, str(tmp_path / "t"), table([]).schema, ["doc_id"], buckets=4)
    stored.replace_documents(table([("A", 1), ("B", 2), ("B", 3), ("C", 4), ("D", 5)]))
    whole = getattr(versioned.VersionedTable, step)

    def lost(self, *args):
        if step == "stage":  # lost while writing: some files are there
            whole(self, args[0].where("x = 30"))
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(versioned.VersionedTable, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            stored.replace_documents(table([("B", 30), ("E", 6)]))
    assert sorted((r.doc_id, r.x) for r in stored.read().collect()) == [("A", 1), ("B", 2), ("B", 3), ("C", 4), ("D", 5)]
    for _ in range(2):
        stored.replace_documents(table([("B", 30), ("E", 6)]))
        assert sorted((r.doc_id, r.x) for r in stored.read().collect()) == [("A", 1), ("B", 30), ("C", 4), ("D", 5), ("E", 6)]
    with pytest.raises(ValueError, match="key"):
        stored.replace_documents(table([("B", 30)]), "x")


def run(query):
    query.awaitTermination(120)
    assert query.exception() is None


def test_ingest_reads_each_file_once(spark, tmp_path):
    source, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    for i in range(3):
        spark.createDataFrame([(f"D{i}", i)], "doc_id string, x int").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.incoming_files(spark, source, "doc_id string, x int", files_per_batch=1)
        run(incremental.start_ingest(stream, lambda df: df.withColumn("y", F.col("x") * 2), out, cp))
    assert sorted((r.doc_id, r.y) for r in spark.read.parquet(out).collect()) == [("D0", 0), ("D1", 2), ("D2", 4)]


def _zipped(members, method=zipfile.ZIP_DEFLATED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as archive:
        for name, raw in members:
            archive.writestr(name, raw)
    return out.getvalue()


def _unpacked(spark, packages_):
    rows = [(f"in/{name}.zip", "h", content) for name, content in packages_.items()]
    found = packages.unpack_files(spark.createDataFrame(rows, "path string, package_sha256 string, content binary").repartition(2))
    good, bad = {}, {}
    for r in found.collect():
        if r.error is not None:
            bad[r.path[3:-4]] = r.error
        else:
            good.setdefault((r.path[3:-4], r.csv_file_name), []).append((r.row_number, r.element_id, r.context_id, r.value, r.item_name))
    return {k: sorted(x) for k, x in good.items()}, bad


def test_tables_of_all_shapes(spark):
    """Quotes, line breaks inside values, short and blank rows, every encoding, stored and deflated members."""
    table = "要素ID\tコンテキストID\t値\t項目名\r\n\"a:b\"\tc\t\"1\t2\n3\"\t\"say \"\"x\"\"\"\r\n\r\nd\te\t\t\r\n"
    ragged = table + "short\tx\r\nlast\ty\t9\tn\r\n"
    full = [(0, "a:b", "c", "1\t2\n3", 'say "x"'), (1, "d", "e", "", "")]
    good, bad = _unpacked(spark, {
        "A": _zipped([("XBRL_TO_CSV/le.csv", table.encode("utf-16")), ("xbrl_to_csv/be.csv", "﻿".encode("utf-16-be") + table.encode("utf-16-be")),
                      ("XBRL_TO_CSV/bare.csv", table.encode("utf-16-le")), ("XBRL_TO_CSV/ragged.csv", ragged.encode("utf-16"))]),
        "B": _zipped([("XBRL_TO_CSV/a.csv", table.encode("utf-16")), ("notes.txt", b"x")], zipfile.ZIP_STORED),
    })
    assert bad == {} and {k: rows for k, rows in good.items() if "ragged" not in k[1]} == {
        ("A", "XBRL_TO_CSV/le.csv"): full, ("A", "xbrl_to_csv/be.csv"): full, ("A", "XBRL_TO_CSV/bare.csv"): full, ("B", "XBRL_TO_CSV/a.csv"): full}
    assert good["A", "XBRL_TO_CSV/ragged.csv"] == [*full, (2, "short", "x", None, None), (3, "last", "y", "9", "n")]


def test_large_table_over_many_blocks(spark):
    lines = [f"e{i}\tc{i}\t{'v' * (i % 90)}" for i in range(40_000)]
    late = lines + ["only\tx"] + [f"l{i}\tc\t1" for i in range(5)]
    head = "Element ID\tContext ID\tValue\n"
    good, bad = _unpacked(spark, {"A": _zipped([
        ("XBRL_TO_CSV/a.csv", (head + "\n".join(lines)).encode("utf-16")), ("XBRL_TO_CSV/b.csv", (head + "\n".join(late)).encode("utf-16")),
        ("XBRL_TO_CSV/c.csv", (head + "e\tc\t" + "w" * 3_000_000).encode("utf-16"))])})
    assert bad == {}
    expected = [(i, f"e{i}", f"c{i}", "v" * (i % 90), "") for i in range(40_000)]
    assert good["A", "XBRL_TO_CSV/a.csv"] == expected
    assert good["A", "XBRL_TO_CSV/b.csv"] == expected + [(40_000, "only", "x", None, "")] + [(40_001 + i, f"l{i}", "c", "1", "") for i in range(5)]
    assert len(good["A", "XBRL_TO_CSV/c.csv"][0][3]) == 3_000_000


def test_a_failed_table_takes_its_package(spark):
    fine = "Element ID\tContext ID\tValue\ne\tc\t1\n".encode("utf-16")
    whole = _zipped([("XBRL_TO_CSV/a.csv", fine), ("XBRL_TO_CSV/b.csv", fine * 50)])
    damaged = bytearray(whole)
    damaged[60] ^= 0xFF
    good, bad = _unpacked(spark, {
        "long": _zipped([("XBRL_TO_CSV/a.csv", fine), ("XBRL_TO_CSV/b.csv", "Element ID\tContext ID\tValue\ne\tc\t1\t2\n".encode("utf-16"))]),
        "odd": _zipped([("XBRL_TO_CSV/a.csv", fine + b"x"), ("XBRL_TO_CSV/b.csv", fine)]),
        "lacks": _zipped([("XBRL_TO_CSV/a.csv", fine), ("XBRL_TO_CSV/b.csv", "Element ID\tValue\n".encode("utf-16"))]),
        "empty": _zipped([("XBRL_TO_CSV/a.csv", b"")]), "none": _zipped([("x.csv", fine)]), "cut": whole[:100], "damaged": bytes(damaged),
        "fine": _zipped([("XBRL_TO_CSV/a.csv", fine)]),
    })
    assert set(good) == {("fine", "XBRL_TO_CSV/a.csv")}
    assert set(bad) == {"long", "odd", "lacks", "empty", "none", "cut", "damaged"}
    assert "longer" in bad["long"] and "UTF-16" in bad["odd"] and "context_id" in bad["lacks"] and "no fact table" in bad["none"]


def test_small_tables_share_their_reader_options(monkeypatch):
    built = []
    options = pa.csv.ConvertOptions
    monkeypatch.setattr(pa.csv, "ConvertOptions", lambda **kinds: built.append(len(kinds["column_types"])) or options(**kinds))
    packages._arrow_options.cache_clear()
    text = "Element ID\tContext ID\tValue\r\njp:a\tc\t007\r\n".encode("utf-16-le")
    for _ in range(5):
        (columns,) = packages.table_columns(text, zipfile.ZIP_STORED, "utf-16-le")
        assert columns["value"].to_pylist() == ["007"]
    assert built == [16]


@pytest.mark.parametrize("start", ["", "\r\n", '"a\nb"\t', "x\t" * 30])
def test_wide_tables_keep_their_texts(start):
    blank = start.strip() == ""
    width = 0 if blank else 30 if start[0] == "x" else 1
    extra = "\t".join(["y"] * 20)
    cells = "\t".join(["1"] * (width + 20) + ["jp:a", "c", "007"])
    head = f"{start}{extra}\tElement ID\tContext ID\tValue"
    text = f"{head}\r\n{cells}\r\n".encode("utf-16-le")
    (columns,) = packages.table_columns(text, zipfile.ZIP_STORED, "utf-16-le")
    assert columns["value"].to_pylist() == ["007"] and columns["element_id"].to_pylist() == ["jp:a"]


def test_small_tables_are_handed_over_together():
    row = {"path": "p", "csv_file_name": "t.csv", "row_number": 0}
    small = (pa.RecordBatch.from_pylist([row], schema=packages._ARROW_SCHEMA) for _ in range(50_000))
    sizes = [batch.num_rows for batch in packages._gathered(small)]
    assert sum(sizes) == 50_000 and len(sizes) < 10 and max(sizes) <= packages._ROWS_PER_BATCH
    assert list(packages._gathered(iter([]))) == []


def test_first_documents_are_read_once(spark, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(100).select(F.col("id").cast("string").alias("doc_id"), "id").mapInArrow(count, "doc_id string, id long")
    stored = versioned.VersionedTable(spark, str(tmp_path), rows.schema, ["doc_id"])
    stored.replace_documents(rows)
    assert read.value == 100
    assert stored.read().count() == 100 and len(stored.head().folders) <= 64
    empty = versioned.VersionedTable(spark, str(tmp_path / "empty"), rows.schema, ["doc_id"])
    empty.replace_documents(rows.where("id < 0"))
    assert empty.read().count() == 0
