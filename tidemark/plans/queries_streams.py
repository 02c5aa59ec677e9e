"""Queries that run the incremental jobs over several arrivals and report what they leave behind."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.text import content_hash
from tidemark.operators import normalize
from tidemark.operators.forecast import METRICS
from tidemark.plans import adapters
from tidemark.plans.oracle_views import ROW_ORDER, iso
from tidemark.plans.queries_pit import ADVANCING, hashed
from tidemark.plans.registry import query, report
from tidemark.session import scratch_path
from tidemark.sources import ledger, packages, versioned
from tidemark.sources.datasets import write_dataset
from tidemark.streaming import change_log, incremental, revisions

_ARRIVALS = (("0000", "1995"), ("1995", "1997"), ("0000", "9999"))


def _worked_off(query) -> None:
    query.awaitTermination()


def _last(metric: str, column: str) -> str:
    return f'round(arg_max({column}, known_at) FILTER (WHERE {column} IS NOT NULL), 8) AS "{metric}"'


@query(
    "str_state",
    f"""SELECT ticker, fy AS cur_fy_end, {', '.join(_last(m, f'f{i}') for i, m in enumerate(METRICS, start=1))},
        max(known_at) AS last_known_at, arg_max(disc_no, known_at) AS last_disc_no
        FROM {ADVANCING} GROUP BY ticker, fy""",
)
def str_state(spark, sf_dir):
    """State after three arrivals, the last of which repeats the others."""
    summary = adapters.forecast_summary(spark, sf_dir)
    landed, features, checkpoint = (scratch_path(spark, f"revisions-{name}") for name in ("in", "out", "state"))
    for start, end in _ARRIVALS:
        arrived = summary.where((F.col("DiscDate") >= start) & (F.col("DiscDate") < end))
        write_dataset(arrived, landed, mode="append")
        stream = incremental.incoming_files(spark, landed, summary.schema)
        _worked_off(revisions.start_forecast_revisions(stream, features, checkpoint))
    return report(revisions.stored_state(spark, checkpoint), 8)


def _seen(days: int) -> str:
    return iso(f"strptime(file_date, '%Y-%m-%d') + INTERVAL {days} DAY + INTERVAL 6 HOUR")


def _change(kind: str, days: int, types: str) -> str:
    known = "known_at" if kind == "new" else f"coalesce({iso('operated - INTERVAL 9 HOUR')}, {_seen(days)})"
    return (
        f"SELECT file_date, seq_number, doc_id, '{kind}' AS change_type, {known} AS known_at, {_seen(days)} AS observed_at "
        f"FROM v_documents WHERE doc_type_code IN ({types})"
    )


@query(
    "str_changes",
    "\nUNION ALL\n".join(
        (_change("new", 3, "'180', '220', '350', '999'"), _change("new", 5, "'120'"), _change("revised", 5, "'350'"),
         _change("revised", 7, "'220', '350'"))
    ),
)
def str_changes(spark, sf_dir):
    """Three lists that arrive last one first, with the first one sent twice: annual reports come with the second list,
    ownership reports change and change back, buybacks change in the third, extraordinary reports are gone from it."""
    documents = adapters.document_list(spark, sf_dir)
    code, cents = F.col("doc_type_code"), F.col("cents")

    def listed(days, rows, amount):
        stamp = adapters.stamp_text(adapters.later("file_date", days))
        return hashed(rows.withColumn("observed_at", stamp), amount)

    first = listed(3, documents.where(code != "120"), cents)
    second = listed(5, documents, F.when(code == "350", cents + 1).otherwise(cents))
    third = listed(7, documents.where(code != "180"), F.when(code == "220", cents + 2).otherwise(cents))
    landed, root, checkpoint = (scratch_path(spark, f"changes-{name}") for name in ("in", "log", "state"))
    log = change_log.ChangeLog(spark, root, change_log.FILINGS, first.schema)
    for arrived in (third, first, second, first):
        write_dataset(arrived, landed, mode="append")
        _worked_off(change_log.start_change_log(incremental.incoming_files(spark, landed, first.schema), log, checkpoint))
    return report(log.changes().select("file_date", "seq_number", "doc_id", "change_type", "known_at", "observed_at"))


_BUDGET = 1000


@query(
    "nrm_index",
    f"""SELECT d.source_key, CASE WHEN m.rows IS NULL THEN 'no_matches' ELSE 'ok' END AS status, coalesce(m.rows, 0) AS rows,
        coalesce(m.metrics, '') AS metrics, m.submit_date, d.size + CASE WHEN part % 10 = 0 THEN 1 ELSE 0 END AS source_size,
        CASE WHEN part % 10 = 0 THEN '000000000005.changed' WHEN newest <= {_BUDGET} THEN '000000000001.first'
             ELSE '000000000003.again' END AS run
        FROM (SELECT *, 'facts/' || doc_id || '.parquet' AS source_key, row_number() OVER (ORDER BY doc_id DESC) AS newest
              FROM (SELECT doc_id, substr(doc_id, 2)::BIGINT AS part, count(*) AS size FROM v_facts GROUP BY 1, 2) s) d
        LEFT JOIN (SELECT f.doc_id, count(*) AS rows, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metrics,
                          first(coalesce(substr(g.submit_datetime, 1, 10), 'unknown')) AS submit_date
                   FROM v_facts f JOIN v_aliases USING (local_name)
                   JOIN (SELECT doc_id, first(submit_datetime ORDER BY {ROW_ORDER}) FILTER (WHERE submit_datetime IS NOT NULL)
                                AS submit_datetime FROM v_facts GROUP BY 1) g ON f.doc_id = g.doc_id
                   GROUP BY 1) m USING (doc_id)""",
)
def nrm_index(spark, sf_dir):
    """Index and visible rows after five runs: within a budget, lost before its manifests, without a budget, with nothing
    to do, and over sources of which a tenth has changed."""
    facts = adapters.statement_facts(spark, sf_dir)
    key = F.concat(F.lit("facts/"), F.col("doc_id"), F.lit(".parquet"))
    facts = facts.withColumn("source_key", key)
    sources = facts.groupBy("source_key").agg(F.count(F.lit(1)).alias("source_size")).withColumn("source_etag", F.lit("v1"))
    listing = scratch_path(spark, "listing")  # landed once: every run reads the listing several times
    write_dataset(sources, listing)
    sources = spark.read.schema(sources.schema).parquet(listing)

    def process(work):
        metrics = normalize.financial_metrics(
            facts.join(work, "source_key", "left_semi"), "run", source_key=F.col("source_key"), row_order=adapters.FACT_ROW_ORDER
        )
        day = ledger.submit_date(F.col("submit_datetime"), F.col("known_at"))
        rows = metrics.withColumns({"source_key": F.col("source_parquet_key"), "submit_date": day})
        return rows.select("source_key", "doc_id", "metric", "numeric_value", "submit_date"), spark.createDataFrame([], "source_key string, error string")

    def lost(work):
        raise RuntimeError("lost")

    schema = process(sources)[0].schema
    runs = ledger.Ledger(spark, scratch_path(spark, "ledger"), schema, v.METRIC_ALIAS_VERSION, "aliases")
    runs.run(sources, process, "first", _BUDGET)
    try:
        runs.run(sources, lost, "lost", _BUDGET)
    except RuntimeError:
        pass
    runs.run(sources, process, "again")
    runs.run(sources, process, "idle")
    changed = F.regexp_extract("source_key", r"S(\d+)\.", 1).cast("long") % 10 == 0
    runs.run(sources.withColumn("source_size", F.col("source_size") + F.when(changed, 1).otherwise(0)), process, "changed")
    visible = runs.rows().groupBy("source_key").agg(
        F.count(F.lit(1)).alias("rows"), F.concat_ws(",", F.sort_array(F.collect_set("metric"))).alias("metrics"), F.min("submit_date").alias("submit_date")
    )
    return runs.index().join(visible, "source_key", "left").select(
        "source_key", "status", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("metrics", F.lit("")).alias("metrics"),
        "submit_date", "source_size", "run",
    )


@query(
    "src_packages",
    """SELECT 'landed/S' || l_suppkey || '.zip' AS path, 'XBRL_TO_CSV/line' || l_linenumber || '.csv' AS csv_file_name,
       row_number() OVER (PARTITION BY l_suppkey, l_linenumber
           ORDER BY l_orderkey, l_partkey, l_extendedprice, l_returnflag) - 1 AS row_number,
       'jp:' || l_orderkey AS element_id, l_returnflag || chr(9) || 'x' AS context_id, printf('%.2f', l_extendedprice) AS value,
       CASE WHEN l_linenumber % 2 = 1 THEN 'part "' || l_partkey || '"' || chr(10) ELSE '' END AS item_name, NULL AS error
       FROM lineitem WHERE l_suppkey % 10 <> 7
         AND l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey % 10 = 3 AND l_linenumber = 5)
       UNION ALL
       SELECT DISTINCT 'landed/S' || l_suppkey || '.zip',
              CASE WHEN l_suppkey % 10 = 3 THEN 'XBRL_TO_CSV/line5.csv' END, NULL::BIGINT, NULL, NULL, NULL, NULL,
              CASE WHEN l_suppkey % 10 = 3 THEN 'fact table lacks columns [''value'']' ELSE 'File is not a zip file' END
       FROM lineitem WHERE l_suppkey % 10 = 7 OR (l_suppkey % 10 = 3 AND l_linenumber = 5)""",
)
def src_packages(spark, sf_dir):
    """Rows of ZIP packages with tables in three encodings; a tenth of the packages is cut, in another a table lacks a column."""
    landed = scratch_path(spark, "landed")
    write_dataset(adapters.fact_packages(spark, sf_dir), landed)
    files = spark.read.schema("path string, content binary").parquet(landed)
    rows = packages.unpack_files(files.withColumn("package_sha256", content_hash(F.col("content"))))
    return rows.select("path", "csv_file_name", "row_number", "element_id", "context_id", "value", "item_name", "error")


@query(
    "snk_replace_documents",
    """SELECT doc_id, metric, round(numeric_value, 6) AS numeric_value, context_id FROM v_metrics WHERE substr(doc_id, 2)::BIGINT % 10 <> 0
       UNION ALL SELECT doc_id, metric, round(-numeric_value, 6), context_id FROM v_metrics
       WHERE substr(doc_id, 2)::BIGINT % 10 = 0 AND context_id <> 'Context1'""",
)
def snk_replace_documents(spark, sf_dir):
    """A table of documents after a tenth of them was written again with fewer and other rows, twice."""
    rows = adapters.statement_metrics(spark, sf_dir).select("doc_id", "metric", "numeric_value", "context_id")
    stored = versioned.VersionedTable(spark, scratch_path(spark, "documents"), rows.schema, ["doc_id"])
    stored.replace_documents(rows)
    again = rows.where((F.substring("doc_id", 2, 100).cast("long") % 10 == 0) & (F.col("context_id") != "Context1"))
    for _ in range(2):
        stored.replace_documents(again.withColumn("numeric_value", -F.col("numeric_value")))
    return report(stored.read().drop(versioned.BUCKET), 6)
