"""Queries over reports: coverage, discovery, storage, health, and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions import numbers, text, times
from tidemark.operators import monitor
from tidemark.plans import adapters
from tidemark.plans.oracle_views import iso
from tidemark.plans.registry import query, report


@query(
    "qa_coverage",
    """SELECT metric, count(*) AS rows, count(DISTINCT doc_id) AS documents, count(DISTINCT stock_code) AS tickers,
       count(numeric_value) AS numeric_rows,
       round(count(DISTINCT doc_id) / (SELECT count(DISTINCT doc_id) FROM v_metrics), 4) AS document_ratio,
       round(count(numeric_value) / count(*), 4) AS numeric_ratio FROM v_metrics GROUP BY 1""",
)
def qa_coverage(spark, sf_dir):
    return monitor.coverage(adapters.statement_metrics(spark, sf_dir))


@query(
    "qa_missing_metrics",
    """SELECT DISTINCT metric FROM v_aliases WHERE metric NOT IN (SELECT metric FROM v_metrics)""",
)
def qa_missing_metrics(spark, sf_dir):
    return monitor.missing_metrics(adapters.statement_metrics(spark, sf_dir))


_KINDS = "\nUNION ALL\n".join(
    f"SELECT '{kind}' AS kind, {kind} AS item, {limit} AS allowed FROM v_metrics WHERE {kind} IS NOT NULL"
    for kind, limit in monitor.FREQUENCY_COLUMNS.items()
)


@query(
    "qa_topk",
    f"""SELECT kind, item, n, CAST(rank AS BIGINT) AS rank FROM (
          SELECT kind, item, allowed, count(*) AS n, row_number() OVER (PARTITION BY kind ORDER BY count(*) DESC, item) AS rank
          FROM ({_KINDS}) k GROUP BY 1, 2, 3) x WHERE rank <= allowed
        UNION ALL
        SELECT 'doc_type_code', doc_type_code, count(DISTINCT doc_id), 0 FROM v_metrics GROUP BY 2""",
)
def qa_topk(spark, sf_dir):
    metrics = adapters.statement_metrics(spark, sf_dir)
    values = monitor.value_frequencies(metrics).withColumn("rank", F.col("rank").cast("long"))
    types = monitor.document_type_counts(metrics).select(
        F.lit("doc_type_code").alias("kind"),
        F.col("doc_type_code").alias("item"),
        F.col("documents").alias("n"),
        F.lit(0).cast("long").alias("rank"),
    )
    return values.unionByName(types)


def _listed(kind: str) -> str:
    return (
        f"(SELECT local_name, string_agg(item || '=' || n::VARCHAR, ';' ORDER BY rk) AS {kind}_top FROM ("
        f"SELECT local_name, {kind} AS item, count(*) AS n, row_number() OVER (PARTITION BY local_name "
        f"ORDER BY count(*) DESC, {kind}) AS rk FROM v_facts WHERE {kind} IS NOT NULL GROUP BY 1, 2) a "
        f"WHERE rk <= 5 GROUP BY 1)"
    )


_UNMATCHED = f"""
SELECT t.local_name, i.item AS item_name, t.rows, t.documents, t.numeric_rows,
       round(t.numeric_rows / t.rows, 4) AS numeric_ratio, u.unit_top AS top_units, c.context_id_top AS top_contexts
FROM (SELECT local_name, count(*) AS rows, count(DISTINCT doc_id) AS documents, CAST(sum(looks_numeric) AS BIGINT) AS numeric_rows
      FROM v_facts WHERE local_name NOT IN (SELECT local_name FROM v_aliases) GROUP BY 1) t
LEFT JOIN (SELECT local_name, item_name AS item FROM (
             SELECT local_name, item_name, row_number() OVER (PARTITION BY local_name ORDER BY count(*) DESC, item_name) AS rk
             FROM v_facts GROUP BY 1, 2) m WHERE rk = 1) i USING (local_name)
LEFT JOIN {_listed('unit')} u USING (local_name)
LEFT JOIN {_listed('context_id')} c USING (local_name)"""


def _joined(column: str):
    return F.concat_ws(";", F.transform(column, lambda c: F.concat_ws("=", c["item"], c["n"].cast("string"))))


@query("qa_unmatched", _UNMATCHED)
def qa_unmatched(spark, sf_dir):
    elements = monitor.unmatched_elements(adapters.statement_facts(spark, sf_dir))
    return elements.select(
        "local_name", "item_name", "rows", "documents", "numeric_rows", "numeric_ratio",
        _joined("top_units").alias("top_units"), _joined("top_contexts").alias("top_contexts"),
    )


_HINTS = ", ".join(f"('{t}', '{h}')" for t, words in v.DISCOVERY_HINTS.items() for h in words)


@query(
    "qa_hints",
    f"""SELECT target, local_name, documents, rows, CAST(rank AS BIGINT) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY target ORDER BY documents DESC, numeric_rows DESC, rows DESC, local_name) AS rank
          FROM (SELECT DISTINCT h.target, e.local_name, e.documents, e.numeric_rows, e.rows
                FROM ({_UNMATCHED}) e JOIN (VALUES {_HINTS}) h(target, word)
                  ON contains(lower(e.local_name || ' ' || coalesce(e.item_name, '')), lower(h.word))) d) r
        WHERE rank <= 50""",
)
def qa_hints(spark, sf_dir):
    elements = monitor.unmatched_elements(adapters.statement_facts(spark, sf_dir))
    matched = monitor.hint_matches(elements)
    return matched.select("target", "local_name", "documents", "rows", F.col("rank").cast("long").alias("rank"))


@query(
    "qa_discovery",
    f"""SELECT * FROM (SELECT local_name, rows, documents, row_number() OVER (ORDER BY rows DESC, local_name) AS rank FROM ({_UNMATCHED}) e)
        WHERE rank <= 200
        UNION ALL SELECT '(total)', count(*), sum(rows)::BIGINT, 0 FROM ({_UNMATCHED}) e""",
)
def qa_discovery(spark, sf_dir):
    return monitor.discovery_report(monitor.unmatched_elements(adapters.statement_facts(spark, sf_dir)))


def _listing(spark, sf_dir):
    key = F.col("o_orderkey").cast("string")
    path = F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("file"), key)).otherwise(
        F.concat_ws("/", F.lower("o_orderstatus"), F.substring("o_orderpriority", 3, 20), key)
    )
    return adapters.table(spark, sf_dir, "orders").select(
        path.alias("path"), F.floor("o_totalprice").cast("long").alias("length")
    )


@query(
    "qa_storage",
    """SELECT label, bytes, objects, round(bytes / 1073741824, 4) AS gib,
       CASE WHEN label = '(total)' THEN round(bytes / 10737418240, 6) END AS budget_ratio,
       CASE WHEN label = '(total)' THEN CASE WHEN bytes / 10737418240 >= 0.95 THEN 'critical'
            WHEN bytes / 10737418240 >= 0.85 THEN 'warning' WHEN bytes / 10737418240 >= 0.70 THEN 'watch' ELSE 'ok' END END AS level
       FROM (SELECT label, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS objects FROM (
               SELECT unnest(CASE WHEN o_orderpriority = '5-LOW' THEN ['(root)', '(root)', '(total)']
                        ELSE [lower(o_orderstatus), lower(o_orderstatus) || '/' || substr(o_orderpriority, 3, 20), '(total)'] END) AS label,
                      CAST(floor(o_totalprice) AS BIGINT) AS length FROM orders) x GROUP BY 1) y""",
)
def qa_storage(spark, sf_dir):
    return monitor.storage_usage(_listing(spark, sf_dir))


@query(
    "qa_prefixes",
    """SELECT p.prefix, count(o_orderkey) AS objects, CAST(coalesce(sum(floor(o_totalprice)), 0) AS BIGINT) AS bytes,
       round(coalesce(sum(floor(o_totalprice)), 0) / 1048576, 3) AS mib
       FROM (VALUES ('f/URGENT/'), ('o/'), ('nothing/')) p(prefix)
       LEFT JOIN orders ON o_orderpriority <> '5-LOW'
         AND starts_with(lower(o_orderstatus) || '/' || substr(o_orderpriority, 3, 20) || '/', p.prefix)
       GROUP BY 1""",
)
def qa_prefixes(spark, sf_dir):
    return monitor.prefix_stats(_listing(spark, sf_dir), ["f/URGENT/", "o/", "nothing/"])


@query(
    "qa_health",
    """SELECT job, path, status, failed_documents, concat_ws(';', 'storage_warning',
         CASE WHEN failed_documents > 0 THEN job || '_failures=' || failed_documents::VARCHAR END,
         CASE WHEN status = 'error' THEN job || '_status_error' END) AS issues, 'attention' AS health
       FROM (SELECT event_type || '-' || user_id::VARCHAR AS job, event_id::VARCHAR AS path,
                    CASE WHEN value > 20 THEN 'error' ELSE 'ok' END AS status,
                    CAST(floor(value / 10) AS BIGINT) AS failed_documents,
                    row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id::VARCHAR DESC) AS rn
             FROM events) x WHERE rn = 1""",
)
def qa_health(spark, sf_dir):
    runs = adapters.table(spark, sf_dir, "events").select(
        F.concat_ws("-", "event_type", F.col("user_id").cast("string")).alias("job"),
        F.col("ts").alias("modified"),
        F.col("event_id").cast("string").alias("path"),
        F.when(F.col("value") > 20, "error").otherwise("ok").alias("status"),
        F.floor(F.col("value") / 10).cast("long").alias("failed_documents"),
    )
    health = monitor.dataset_health(runs, "warning")
    return health.select("job", "path", "status", "failed_documents", F.concat_ws(";", "issues").alias("issues"), "health")


@query(
    "qa_series",
    """SELECT n_name AS code, CASE WHEN n_regionkey = 0 THEN 500 ELSE 200 END AS status,
       count(s_suppkey) AS recent_rows,
       CAST(n_regionkey <> 0 AND count(s_suppkey) > 0 AS VARCHAR) AS ok
       FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name, n_regionkey""",
)
def qa_series(spark, sf_dir):
    """Each nation is a configured series; region 0 answered with an error status."""
    nations = adapters.table(spark, sf_dir, "nation")
    configured = nations.select(F.lit("sample").alias("dataset"), F.lit("DB").alias("db"), F.col("n_name").alias("code"))
    responses = nations.select(
        F.lit("DB").alias("db"), F.col("n_name").alias("code"), F.when(F.col("n_regionkey") == 0, 500).otherwise(200).alias("status")
    )
    suppliers = adapters.table(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    observations = suppliers.select(F.lit("DB").alias("db"), F.col("n_name").alias("code"), F.col("n_name").alias("series_id"))
    checked = monitor.series_check(configured, responses, observations)
    return report(checked.select("code", "status", "recent_rows", "ok"))


@query(
    "scl_codes",
    """SELECT c_custkey, CASE WHEN length(code) = 5 AND right(code, 1) = '0' THEN substr(code, 1, 4)
                              WHEN length(code) = 4 THEN code END AS security_code,
       CASE WHEN length(code) = 5 AND right(code, 1) = '0' THEN substr(code, 1, 4) ELSE code END AS disclosure_ticker,
       code AS clean_code
       FROM (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN lpad(c_custkey::VARCHAR, greatest(length(c_custkey::VARCHAR), 4)::INTEGER, '0') || '0'
                    WHEN c_acctbal > 2000 THEN lpad(c_custkey::VARCHAR, greatest(length(c_custkey::VARCHAR), 3)::INTEGER, '0') || substr(c_mktsegment, 1, 1)
                    ELSE c_custkey::VARCHAR END AS code FROM customer) x""",
)
def scl_codes(spark, sf_dir):
    key, balance = F.col("c_custkey").cast("string"), F.col("c_acctbal")
    code = (
        F.when(balance > 5000, F.concat(adapters.padded(key, 4), F.lit("0 ")))
        .when(balance > 2000, F.concat(F.lit("　"), adapters.padded(key, 3), F.substring("c_mktsegment", 1, 1)))
        .otherwise(F.concat(key, F.lit(".0")))
    )
    return adapters.table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.security_code(code).alias("security_code"),
        text.disclosure_ticker(code).alias("disclosure_ticker"),
        text.clean_code(code).alias("clean_code"),
    )


@query(
    "scl_numbers",
    """SELECT l_orderkey, l_linenumber, l_partkey, numeric_value AS statement_number,
       CASE WHEN looks_numeric = 1 THEN 'true' ELSE 'false' END AS looks_numeric,
       CASE WHEN raw_value LIKE '%\\%%' ESCAPE '\\' THEN l_partkey / 100.0
            WHEN raw_value LIKE '1.5e%' THEN numeric_value END AS ratio_number,
       round(numeric_value / nullif(l_linenumber - 3, 0), 8) AS safe_ratio
       FROM v_facts""",
)
def scl_numbers(spark, sf_dir):
    facts = adapters.statement_facts(spark, sf_dir)
    value = numbers.statement_number(F.col("value"))
    rows = facts.select(
        F.col("row_a").alias("l_orderkey"),
        F.col("row_b").alias("l_linenumber"),
        F.col("row_d").alias("l_partkey"),
        value.alias("statement_number"),
        numbers.looks_numeric(F.col("value")).alias("looks_numeric"),
        numbers.ratio_number(F.col("value")).alias("ratio_number"),
        F.round(numbers.safe_ratio(value, F.col("row_b") - 3), 8).alias("safe_ratio"),
    )
    return report(rows)


_SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"


@query(
    "scl_text",
    f"""SELECT doc_id, sha256(cleaned) AS text_sha256, length(cleaned) AS characters,
        sha256(regexp_extract(cleaned, '[^:]*$')) AS last_part_sha256,
        substr(cleaned, 1, 10) AS first_ten
        FROM (SELECT doc_id, regexp_replace(text, '^{_SPACE}|{_SPACE}$', '', 'g') AS cleaned FROM documents) d""",
)
def scl_text(spark, sf_dir):
    cleaned = text.clean(F.col("text"))
    return adapters.table(spark, sf_dir, "documents").select(
        "doc_id",
        text.content_hash(cleaned).alias("text_sha256"),
        F.length(cleaned).cast("long").alias("characters"),
        text.content_hash(text.local_name(cleaned)).alias("last_part_sha256"),
        text.first_ten(F.col("text")).alias("first_ten"),
    )


@query(
    "scl_times",
    f"""SELECT event_id, CASE WHEN microsecond(ts) % 1000000 = 0 THEN {iso('ts')}
                         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS iso_z,
        {iso('ts - INTERVAL 9 HOUR')} AS from_local, {iso('ts')} AS from_offset FROM events""",
)
def scl_times(spark, sf_dir):
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ahead = F.date_format(F.col("ts").cast("timestamp") + F.expr("INTERVAL 9 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    rows = adapters.table(spark, sf_dir, "events").select(
        "event_id",
        times.iso_z(F.col("ts").cast("timestamp")).alias("iso_z"),
        times.jst_text(seconds).alias("from_local"),
        times.jst_text(F.concat(ahead, F.lit("+09:00"))).alias("from_offset"),
    )
    return report(rows)
