"""Queries over payload sources, manifests, document selection and normalisers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions import times
from tidemark.functions.text import content_hash
from tidemark.operators import changes, normalize, select
from tidemark.operators.financial import financial_features
from tidemark.operators.dimensions import document_rules
from tidemark.plans import adapters
from tidemark.plans.oracle_views import ROW_ORDER, day, iso
from tidemark.plans.registry import query, report
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import catalog, datasets, documents, packages, provider, series


@query(
    "src_partitioned_read",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice, {day('o_orderdate')} AS order_day,
        CASE WHEN year(o_orderdate) >= 1997 THEN o_orderpriority END AS o_orderpriority, year(o_orderdate)::INTEGER AS order_year
        FROM orders""",
)
def src_partitioned_read(spark, sf_dir):
    """All orders written by year, older years without a later column, and read back by partition and by name."""
    root = f"{ensure_checkpoint_dir(spark)}/orders-{uuid.uuid4().hex}"
    orders = adapters.table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    datasets.write_dataset(orders.where("order_year < 1997").drop("o_orderpriority"), root, ["order_year"], mode="append")
    datasets.write_dataset(orders.where("order_year >= 1997"), root, ["order_year"], mode="append")
    stored = datasets.read_dataset(spark, root)
    day_of = F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_day")
    return report(
        stored.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day_of, "o_orderpriority", "order_year"), 2
    )


def _series_payloads(spark, sf_dir):
    """One provider response per event: two periods, or unequal arrays for error events."""
    value = F.col("value").cast("string")
    second = F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.lit(',"NA"'))
    response = F.format_string(
        '{"STATUS":200,"RESULTSET":[{"SERIES_CODE":"U%d","NAME_OF_TIME_SERIES":"user","UNIT":"u","FREQUENCY":"DAILY",'
        '"CATEGORY":"c","LAST_UPDATE":%s,"VALUES":{"SURVEY_DATES":[%s,20240199],"VALUES":[%s%s]}}]}',
        F.col("user_id"),
        F.when(F.col("event_type") == "view", F.lit('""')).otherwise(F.date_format("ts", "yyyyMMdd")),
        F.date_format("ts", "yyyyMMdd"),
        value,
        second,
    )
    return adapters.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("dataset"),
        F.lit("DB").alias("db"),
        response.alias("payload"),
        adapters.stamp_text(adapters.later("ts", 2)).alias("observed_at"),
        F.lit("sample").alias("source_url"),
        content_hash(response).alias("payload_sha256"),
    )


@query(
    "src_series_json",
    f"""SELECT event_type AS dataset, 'U' || user_id::VARCHAR AS series_id, period AS period_code,
        round(val, 6) AS value,
        CASE WHEN event_type <> 'view' THEN {day('ts')} END AS source_last_update,
        CASE WHEN event_type = 'view' THEN strftime(ts + INTERVAL 2 DAY, '%Y-%m-%dT06:00:00Z')
             ELSE strftime(ts, '%Y-%m-%dT14:59:59Z') END AS known_at
        FROM (SELECT *, strftime(ts, '%Y%m%d') AS period, value AS val FROM events
              UNION ALL SELECT *, '20240199', NULL FROM events) e
        WHERE event_type <> 'error'""",
)
def src_series_json(spark, sf_dir):
    observations, _ = series.read_series(series.series_items(_series_payloads(spark, sf_dir)), "run")
    return report(
        observations.select("dataset", "series_id", "period_code", "value", "source_last_update", "known_at"), 6
    )


@query(
    "nrm_rejects",
    """SELECT event_id, 'dates and values differ in length' AS error FROM events WHERE event_type = 'error' AND event_id % 5 > 2
       UNION ALL
       SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'unreadable payload' WHEN 1 THEN 'status is not 200'
                                          ELSE 'more pages follow' END FROM events WHERE event_id % 5 <= 2
       UNION ALL
       SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'unreadable payload' WHEN 1 THEN 'status is not 200'
                                              ELSE 'bad seqNumber' END FROM orders WHERE o_orderkey % 4 <= 2
       UNION ALL
       SELECT c_custkey, CASE c_custkey % 2 WHEN 0 THEN 'unreadable payload' ELSE 'no catalog object' END FROM customer""",
)
def nrm_rejects(spark, sf_dir):
    """Everything readers refuse: responses as a whole, and series whose arrays differ in length."""
    kind = F.col("event_id") % 5
    broken = (
        F.when(kind == 0, F.lit("{broken"))
        .when(kind == 1, F.lit('{"STATUS":500,"RESULTSET":[]}'))
        .when(kind == 2, F.regexp_replace("payload", '^\\{', '{"NEXTPOSITION":7,'))
        .otherwise(F.col("payload"))
    )
    payloads = _series_payloads(spark, sf_dir).withColumn("payload", broken)
    _, unequal = series.read_series(series.series_items(payloads), "run")
    order = F.col("o_orderkey")
    listed = (
        F.when(order % 4 == 0, F.lit("[oops"))
        .when(order % 4 == 1, F.lit('{"metadata":{"status":"404"},"results":[]}'))
        .when(order % 4 == 2, F.lit('{"metadata":{"status":"200"},"results":[{"seqNumber":"x"}]}'))
        .otherwise(F.format_string('{"metadata":{"status":"200"},"results":[{"seqNumber":"%d"}]}', order))
    )
    lists = adapters.table(spark, sf_dir, "orders").select("o_orderkey", listed.alias("payload"))
    customer = F.col("c_custkey")
    terms = adapters.table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(customer % 2 == 0, F.lit("<html>")).otherwise(F.lit('{"error":1}')).alias("payload")
    )
    return (
        unequal.select("event_id", "error")
        .union(series.series_rejects(payloads).select("event_id", "error"))
        .union(documents.document_list_rejects(lists).select("o_orderkey", "error"))
        .union(catalog.catalog_rejects(terms).select("c_custkey", "error"))
    )


@query(
    "nrm_fact_rejects",
    """SELECT 'metrics' AS kind, l_orderkey, l_linenumber, 'no doc_id' AS error FROM lineitem WHERE l_partkey % 7 = 0
       UNION ALL SELECT 'ownership', l_orderkey, l_linenumber, 'no doc_id' FROM lineitem WHERE l_orderkey % 5 = 0
       UNION ALL SELECT 'package', l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'broken' ELSE 'no list row' END
       FROM lineitem WHERE l_linenumber = 1 OR l_orderkey % 3 = 0""",
)
def nrm_fact_rejects(spark, sf_dir):
    """Facts that normalisers refuse: those that name no document, and those of packages unreadable or without a list row."""
    lines = adapters.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    keys = ["l_orderkey", "l_linenumber"]
    metrics = lines.select(*keys, F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey").cast("string")).alias("doc_id"))
    reports = lines.select(*keys, F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey").cast("string")).alias("doc_id"))
    rows = lines.select(
        *keys,
        F.format_string("landed/D%d.zip", "l_orderkey").alias("path"),
        F.when(F.col("l_linenumber") == 1, "broken").alias("error"),
    )
    orders = adapters.table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 != 0)
    listed = orders.select(F.format_string("D%d", "o_orderkey").alias("doc_id"))
    kinds = {
        "metrics": normalize.split_facts(metrics)[1],
        "ownership": normalize.split_facts(reports)[1],
        "package": packages.package_rejects(rows, listed),
    }
    first, *rest = [df.select(F.lit(kind).alias("kind"), *keys, "error") for kind, df in kinds.items()]
    for df in rest:
        first = first.union(df)
    return first


@query(
    "src_catalog_json",
    """SELECT 'term' || (c_nationkey)::VARCHAR AS search_term, c_custkey::VARCHAR AS "@id",
       CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS "TITLE.$", c_name AS "STAT_NAME.$"
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def src_catalog_json(spark, sf_dir):
    """Catalog responses: a lone object, or a list without tables for building customers."""
    title = F.when(F.col("c_acctbal") > 0, F.concat(F.lit(',"TITLE":{"$":"'), "c_mktsegment", F.lit('"}'))).otherwise("")
    table_json = F.concat(
        F.lit('{"@id":"'), F.col("c_custkey").cast("string"), F.lit('","STAT_NAME":{"$":"'), "c_name", F.lit('"}'), title, F.lit("}")
    )
    listed = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("[]")).when(
        F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("["), table_json, F.lit("]"))
    ).otherwise(table_json)
    payload = F.concat(F.lit('{"GET_STATS_LIST":{"DATALIST_INF":{"TABLE_INF":'), listed, F.lit("}}}"))
    payloads = adapters.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("term"), F.col("c_nationkey").cast("string")).alias("search_term"),
        payload.alias("payload"),
        F.lit("2024-01-01T00:00:00Z").alias("observed_at"),
        content_hash(payload).alias("payload_sha256"),
    )
    schema = "`@id` string, TITLE struct<`$`: string>, STAT_NAME struct<`$`: string>"
    tables = catalog.flatten_tables(payloads, schema, "run")
    return tables.select("search_term", "`@id`", "`TITLE.$`", "`STAT_NAME.$`")


@query(
    "src_document_list",
    """SELECT o_orderkey AS seq_number, 'S' || o_orderkey::VARCHAR AS doc_id, substr(c_name, 1, 4) AS stock_code,
       strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS known_at, o_orderpriority AS doc_description
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def src_document_list(spark, sf_dir):
    """One list response per order, as the provider sends it."""
    customers = adapters.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = adapters.table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    payload = F.format_string(
        '{"metadata":{"status":"200","processDateTime":"%s 23:00"},"results":[{"seqNumber":%d,"docID":"S%d",'
        '"secCode":"%s","submitDateTime":"%s 10:00","docDescription":"%s","opeDateTime":null}]}',
        adapters.day_text("o_orderdate"),
        F.col("o_orderkey"),
        F.col("o_orderkey"),
        F.col("c_name"),
        adapters.day_text("o_orderdate"),
        F.col("o_orderpriority"),
    )
    payloads = orders.select(
        adapters.day_text("o_orderdate").alias("file_date"),
        payload.alias("payload"),
        adapters.stamp_text("o_orderdate", "15:00:00").alias("observed_at"),
        F.lit("sample").alias("source_url"),
    )
    listed = documents.read_document_list(payloads, "run", strict=False)
    return report(listed.select("seq_number", "doc_id", "stock_code", "known_at", "doc_description"))


@query(
    "src_provider_stamp",
    f"""SELECT o_orderkey, {day('o_orderdate')} AS "DiscDate", 'jquants_v2' AS source_id,
        'financial_summary' AS dataset, {day('o_orderdate + INTERVAL 2 DAY')} AS retrieval_target_date,
        {iso("o_orderdate + INTERVAL 6 HOUR + INTERVAL 30 MINUTE")} AS known_at,
        strftime(o_orderdate + INTERVAL 86 DAY, '%Y-%m-%dT06:00:00Z') AS observed_at FROM orders""",
)
def src_provider_stamp(spark, sf_dir):
    orders = adapters.table(spark, sf_dir, "orders")
    frame = orders.select(
        "o_orderkey",
        F.col("o_orderdate").alias("DiscDate"),
        F.lit("15:30:00").alias("DiscTime"),
        adapters.stamp_text(adapters.later("o_orderdate", 86)).alias("__fetched"),
        adapters.day_text(adapters.later("o_orderdate", 2)).alias("__target"),
    )
    stamped = provider.stamp(frame, "financial_summary", F.col("__target"), F.col("__fetched"))
    return report(
        stamped.select("o_orderkey", "DiscDate", "source_id", "dataset", "retrieval_target_date", "known_at", "observed_at")
    )


@query(
    "snk_changed_payloads",
    """SELECT event_id, sha256(props) AS sha256 FROM events WHERE event_type IN ('signup', 'purchase')""",
)
def snk_changed_payloads(spark, sf_dir):
    """Signup payloads were never kept and purchase payloads were kept in another version."""
    payloads = adapters.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("manifest_id"), F.col("props").alias("payload"), "event_type"
    )
    old = F.when(F.col("event_type") == "purchase", F.concat("payload", F.lit(" "))).otherwise(F.col("payload"))
    kept = payloads.where(F.col("event_type") != "signup").select("manifest_id", content_hash(old).alias("sha256"))
    changed = changes.changed_payloads(payloads, kept)
    return changed.select(F.col("manifest_id").alias("event_id"), "sha256")


@query(
    "fil_select_documents",
    """SELECT doc_id, category, priority, submit_datetime, download_csv::VARCHAR AS download_csv
       FROM v_documents JOIN (SELECT * REPLACE (category <> 'event' AS download_csv) FROM v_rules) r USING (doc_type_code)
       WHERE csv_flag = '1' AND download_csv""",
)
def fil_select_documents(spark, sf_dir):
    """Rules that leave event reports alone."""
    rules = document_rules(spark).withColumn("download_csv", F.col("category") != "event")
    chosen = select.select_documents(adapters.document_list(spark, sf_dir), rules, ordered=True)
    return report(chosen.select("doc_id", "category", "priority", "submit_datetime", "download_csv"))


@query(
    "fil_candidates",
    f"""SELECT doc_id, category, priority, file_date FROM (
          SELECT doc_id, category, priority, submit_datetime,
                 CASE WHEN operated IS NOT NULL THEN {day('operated')} ELSE file_date END AS file_date
          FROM v_documents JOIN v_rules USING (doc_type_code)
          WHERE csv_flag = '1' AND cents >= 15000000 AND doc_type_code IN ('120', '130', '350', '360')) c
        ORDER BY priority, submit_datetime, doc_id LIMIT 150""",
)
def fil_candidates(spark, sf_dir):
    """Operated documents are listed a second time on their operation day; small ones are done."""
    listed = adapters.document_list(spark, sf_dir)
    again = listed.where(F.col("operation_datetime").isNotNull()).withColumn(
        "file_date", F.substring("operation_datetime", 1, 10)
    )
    processed = listed.where(F.col("cents") < 15_000_000)
    codes = [*v.BACKFILL_PHASES["financial_annual"], *v.BACKFILL_PHASES["ownership"]]
    chosen = select.candidates(listed.unionByName(again), processed, 150, type_codes=codes)
    return chosen.select("doc_id", "category", "priority", "file_date")


@query(
    "nrm_pending",
    """SELECT source_key FROM (SELECT 'facts/' || doc_id || '.parquet' AS source_key, doc_type_code, csv_flag FROM v_documents)
       x WHERE doc_type_code IN ('120', '350', '180') OR csv_flag = '0' ORDER BY source_key DESC LIMIT 500""",
)
def nrm_pending(spark, sf_dir):
    """Annual reports are not indexed, ownership ones failed, extraordinary ones changed, flag 0 has no etag."""
    listed = adapters.document_list(spark, sf_dir)
    code = F.col("doc_type_code")
    sources = listed.select(
        F.concat(F.lit("facts/"), "doc_id", F.lit(".parquet")).alias("source_key"),
        F.when(F.col("csv_flag") == "1", F.col("cents").cast("string")).alias("source_etag"),
        F.col("cents").alias("source_size"),
        "doc_type_code",
    )
    index = sources.where(code != "120").select(
        "source_key",
        F.when(code == "180", "old").otherwise(F.col("source_etag")).alias("source_etag"),
        "source_size",
        F.when(code == "350", "error").otherwise("ok").alias("status"),
        F.lit(v.METRIC_ALIAS_VERSION).alias("alias_config_version"),
        F.lit("hash").alias("alias_config_sha256"),
    )
    pending = select.pending_sources(
        sources, index, alias_version=v.METRIC_ALIAS_VERSION, alias_sha256="hash", limit=500
    )
    return pending.select("source_key")


def _normalized(spark, sf_dir):
    return normalize.financial_metrics(
        adapters.statement_facts(spark, sf_dir), "run", row_order=adapters.FACT_ROW_ORDER
    )


@query(
    "nrm_financial_metrics",
    f"""SELECT f.doc_id, a.metric, f.local_name, 'jp_cor:' || f.local_name AS element_id, f.item_name, f.context_id, f.unit,
        f.raw_value, round(f.numeric_value, 6) AS numeric_value, d.filer_name, d.submit_datetime
        FROM v_facts f JOIN v_aliases a USING (local_name)
        JOIN (SELECT doc_id, first(filer_name ORDER BY {ROW_ORDER}) FILTER (WHERE filer_name IS NOT NULL) AS filer_name,
                     first(submit_datetime ORDER BY {ROW_ORDER}) FILTER (WHERE submit_datetime IS NOT NULL) AS submit_datetime
              FROM v_facts GROUP BY 1) d ON f.doc_id = d.doc_id""",
)
def nrm_financial_metrics(spark, sf_dir):
    columns = [
        "doc_id", "metric", "local_name", "element_id", "item_name", "context_id", "unit", "raw_value",
        "numeric_value", "filer_name", "submit_datetime",
    ]
    return report(_normalized(spark, sf_dir).select(*columns), 6)


@query(
    "snk_manifest",
    """SELECT d.doc_id, CASE WHEN m.rows IS NULL THEN 'no_matches' ELSE 'ok' END AS status,
       coalesce(m.rows, 0) AS rows, coalesce(m.metrics, '') AS metrics
       FROM (SELECT DISTINCT doc_id FROM v_facts) d
       LEFT JOIN (SELECT doc_id, count(*) AS rows, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metrics
                  FROM v_facts JOIN v_aliases USING (local_name) GROUP BY 1) m USING (doc_id)""",
)
def snk_manifest(spark, sf_dir):
    metrics = _normalized(spark, sf_dir).select("doc_id", "metric")
    worked = adapters.statement_facts(spark, sf_dir).select("doc_id").distinct()
    manifest = datasets.document_manifest(metrics, worked)
    return manifest.select("doc_id", "status", "rows", F.concat_ws(",", "metrics").alias("metrics"))


def _report_first(names: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"first(val ORDER BY ord) FILTER (WHERE local_name IN ({listed}) AND val IS NOT NULL)"


_HOLDER = ", ".join(f"{_report_first(names)} AS {c}" for c, names in v.OWNERSHIP_HOLDER_ELEMENTS.items())
_COVER = ", ".join(
    f"{_report_first(v.OWNERSHIP_DOCUMENT_ELEMENTS[c])} AS {c}"
    for c in ("document_title", "filing_date", "issuer_name", "issuer_security_code", "stock_listing", "total_filers_joint_holders")
)
_HOLDER_NAMES = ", ".join(f"'{n}'" for names in v.OWNERSHIP_HOLDER_ELEMENTS.values() for n in names)


def _as_number(column: str) -> str:
    plain = f"replace(replace({column}, ',', ''), ' ', '')"
    return f"(CASE WHEN {plain} LIKE '%％' THEN try_cast(replace({plain}, '％', '') AS DOUBLE) / 100 ELSE try_cast({plain} AS DOUBLE) END)"


@query(
    "nrm_ownership_summary",
    f"""SELECT d.doc_id, d.doc_type_code, d.document_title, CAST(contains(coalesce(d.document_title, ''), '変更報告書') AS VARCHAR)
        AS is_change_report,
        CAST(d.doc_type_code = '360' OR contains(coalesce(d.document_title, ''), '訂正') AS VARCHAR) AS is_correction,
        d.submit_datetime, d.filing_date, d.issuer_name, substr(d.issuer_security_code, 1, 4) AS issuer_stock_code,
        d.stock_listing, {_as_number('d.total_filers_joint_holders')} AS total_filers_joint_holders,
        h.context_id AS holder_context_id, h.holder_name, h.purpose, h.shares_held AS shares_held_raw,
        {_as_number('h.shares_held')} AS shares_held, h.holding_ratio AS holding_ratio_raw,
        round({_as_number('h.holding_ratio')}, 8) AS holding_ratio,
        round({_as_number('h.holding_ratio')} - {_as_number('h.previous_holding_ratio')}, 8) AS holding_ratio_change,
        coalesce(h.evidence, '') AS evidence
        FROM (SELECT doc_id, min(doc_type_code) AS doc_type_code, first(submit_datetime ORDER BY ord) AS submit_datetime, {_COVER}
              FROM v_report GROUP BY 1) d
        LEFT JOIN (SELECT * FROM (
                     SELECT doc_id, context_id, {_HOLDER}, string_agg(DISTINCT 'jp_lvh:' || local_name, ',' ORDER BY 'jp_lvh:' || local_name) AS evidence
                     FROM v_report WHERE local_name IN ({_HOLDER_NAMES}) GROUP BY 1, 2) x
                   WHERE coalesce(purpose, shares_held, potential_shares, holding_ratio, previous_holding_ratio) IS NOT NULL) h
        ON d.doc_id = h.doc_id""",
)
def nrm_ownership_summary(spark, sf_dir):
    summary = normalize.ownership_summary(
        adapters.report_facts(spark, sf_dir), "run", row_order=adapters.FACT_ROW_ORDER
    )
    return report(
        summary.select(
            "doc_id", "doc_type_code", "document_title", "is_change_report", "is_correction", "submit_datetime",
            "filing_date", "issuer_name", "issuer_stock_code", "stock_listing", "total_filers_joint_holders",
            "holder_context_id", "holder_name", "purpose", "shares_held_raw", "shares_held", "holding_ratio_raw",
            "holding_ratio", "holding_ratio_change", F.concat_ws(",", "evidence_element_ids").alias("evidence"),
        ),
        8,
    )


_SCORE = """(CASE WHEN relative_year = 'CurrentYear' THEN 0 ELSE 1 END),
 (CASE WHEN consolidation = '連結' THEN 0 WHEN consolidation IS NULL THEN 1 ELSE 2 END),
 (CASE WHEN metric IN ({balance}) THEN CASE WHEN period_type = 'instant' THEN 0 WHEN period_type IS NULL THEN 1 ELSE 2 END
       ELSE CASE WHEN period_type = 'duration' THEN 0 WHEN period_type IS NULL THEN 1 ELSE 2 END END)""".format(
    balance=", ".join(f"'{m}'" for m in v.BALANCE_METRICS)
)
_PICKS = ", ".join(f"max(numeric_value) FILTER (WHERE metric = '{m}') AS {m}" for m in v.RATIO_METRICS)
_PARTS = " + ".join(f"coalesce({m}, 0)" for m in v.DEBT_COMPONENTS)
_SOME_PART = f"coalesce({', '.join(v.DEBT_COMPONENTS)})"
_RATIOS = {
    "interest_bearing_debt_components_proxy": "parts",
    "roe": "net_income / nullif(equity, 0)",
    "roic_pre_tax_proxy": "operating_income / nullif(capital, 0)",
    "roic": "CASE WHEN tax BETWEEN 0 AND 1 THEN operating_income * (1 - tax) / nullif(capital, 0) END",
    "buyback_cash_outflow": "abs(treasury_stock_purchase_cash_flow)",
    "buyback_to_equity": "CASE WHEN equity > 0 THEN abs(treasury_stock_purchase_cash_flow) / equity END",
    "fcf_conversion": "(operating_cash_flow - abs(capital_expenditure)) / nullif(net_income, 0)",
    "net_debt": "interest_bearing_debt - cash_and_deposits",
    "net_debt_components_proxy": "CASE WHEN interest_bearing_debt IS NULL THEN parts - cash_and_deposits END",
}
_RATIO_ROWS = "\nUNION ALL\n".join(
    f"SELECT period_end AS date, stock_code AS ticker, '{name}' AS feature, round({value}, 6) AS value, "
    f"known_at, observed_at, doc_id AS source_doc_id FROM ratios"
    for name, value in _RATIOS.items()
)


@query(
    "ftr_financial",
    f"""SELECT * FROM (WITH ratios AS (
          SELECT *, equity + coalesce(interest_bearing_debt, parts) - cash_and_deposits AS capital,
                 income_tax / nullif(pretax_income, 0) AS tax
          FROM (SELECT *, coalesce(shareholders_equity, net_assets) AS equity,
                       CASE WHEN {_SOME_PART} IS NOT NULL THEN {_PARTS} END AS parts
                FROM (SELECT doc_id, first(stock_code ORDER BY {ROW_ORDER}) FILTER (WHERE stock_code IS NOT NULL) AS stock_code,
                             first(period_end ORDER BY {ROW_ORDER}) AS period_end,
                             first(known_at ORDER BY {ROW_ORDER}) AS known_at,
                             first(observed_at ORDER BY {ROW_ORDER}) AS observed_at
                      FROM v_metrics GROUP BY 1) d
                JOIN (SELECT doc_id, {_PICKS} FROM (
                        SELECT *, row_number() OVER (PARTITION BY doc_id, metric ORDER BY {_SCORE}, {ROW_ORDER}) AS rn
                        FROM v_metrics WHERE numeric_value IS NOT NULL) r WHERE rn = 1 GROUP BY 1) p USING (doc_id)) e)
        {_RATIO_ROWS}) f WHERE value IS NOT NULL AND ticker IS NOT NULL""",
)
def ftr_financial(spark, sf_dir):
    metrics = adapters.statement_metrics(spark, sf_dir)
    return report(financial_features(metrics, adapters.FACT_ROW_ORDER), 6)


@query(
    "snk_run_manifest",
    """SELECT count(*) FILTER (WHERE n > 0) AS processed_documents, count(*) FILTER (WHERE n = 0) AS no_match_documents,
       CAST(0 AS BIGINT) AS failed_documents, CAST(sum(n) AS BIGINT) AS rows_written
       FROM (SELECT doc_id, count(metric) AS n FROM v_facts LEFT JOIN v_aliases USING (local_name) GROUP BY 1) d""",
)
def snk_run_manifest(spark, sf_dir):
    metrics = _normalized(spark, sf_dir).select("doc_id", "metric")
    worked = adapters.statement_facts(spark, sf_dir).select("doc_id").distinct()
    return datasets.run_manifest(datasets.document_manifest(metrics, worked))
