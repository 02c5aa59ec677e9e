"""Queries over availability rules, as-of reconstruction and change logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions import times
from tidemark.operators import changes, pit, quality
from tidemark.operators.dimensions import feature_catalog, orient_features
from tidemark.operators.forecast import forecast_revisions, forecast_revisions_with_state
from tidemark.operators.ownership import ownership_features
from tidemark.plans import adapters
from tidemark.plans.oracle_views import ROW_ORDER, iso
from tidemark.plans.registry import query, report
from tidemark.session import ensure_checkpoint_dir

DECISION = "2000-06-30T06:00:00Z"
VERSION_KEYS = ["stock_code", "metric", "context_id", "relative_year", "consolidation"]


@query(
    "fil_asof",
    f"SELECT doc_id, holder_name, known_at FROM v_ownership WHERE known_at <= '{DECISION}'",
)
def fil_asof(spark, sf_dir):
    known = pit.filter_asof(adapters.ownership_rows(spark, sf_dir), DECISION)
    return report(known.select("doc_id", "holder_name", "known_at"))


@query(
    "fil_ownership_asof",
    f"""SELECT doc_id, issuer_stock_code, holder_name, round(holding_ratio_change, 8) AS holding_ratio_change, known_at
        FROM v_ownership WHERE known_at <= '{DECISION}' AND holding_ratio_change IS NOT NULL""",
)
def fil_ownership_asof(spark, sf_dir):
    known = pit.known_changes(adapters.ownership_rows(spark, sf_dir), DECISION)
    return report(known.select("doc_id", "issuer_stock_code", "holder_name", "holding_ratio_change", "known_at"), 8)


_REVISION_VIEW = f"""
SELECT ticker, feature, date, value, known_at, observed_at FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY known_at DESC, observed_at DESC, date DESC) AS rn
  FROM (SELECT issuer_stock_code AS ticker, 'ownership_ratio_change' AS feature, date, round(change, 8) AS value,
               known_at, observed_at
        FROM ({{picked}}) p) f
  WHERE known_at <= '{DECISION}') x WHERE rn = 1"""

OWNERSHIP_PICK = f"""
SELECT doc_id, issuer_stock_code, known_at, observed_at, coalesce(filing_date, substr(known_at, 1, 10)) AS date,
       change, holder_name
FROM (SELECT d.*, c.change, c.holder_name
      FROM (SELECT doc_id, first(issuer_stock_code ORDER BY {ROW_ORDER}) AS issuer_stock_code,
                   first(known_at ORDER BY {ROW_ORDER}) AS known_at,
                   first(observed_at ORDER BY {ROW_ORDER}) AS observed_at,
                   first(filing_date ORDER BY {ROW_ORDER}) FILTER (WHERE filing_date IS NOT NULL) AS filing_date
            FROM v_ownership GROUP BY 1) d
      JOIN (SELECT doc_id, change, holder_name FROM (
              SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY abs(change) DESC, {ROW_ORDER},
                                           change, holder_name) AS rn
              FROM (SELECT *, coalesce(holding_ratio_change, holding_ratio - previous_holding_ratio) AS change
                    FROM v_ownership) o
              WHERE change IS NOT NULL) r WHERE rn = 1) c USING (doc_id)) j"""


@query("pit_latest_feature", _REVISION_VIEW.replace("{picked}", OWNERSHIP_PICK))
def pit_latest_feature(spark, sf_dir):
    features = ownership_features(adapters.ownership_rows(spark, sf_dir), adapters.FACT_ROW_ORDER)
    latest = pit.latest_asof(features, DECISION)
    return report(latest.select("ticker", "feature", "date", "value", "known_at", "observed_at"), 8)


@query(
    "pit_latest_fact",
    f"""SELECT stock_code, metric, context_id, relative_year, consolidation, doc_id, known_at, observed_at FROM (
          SELECT *, row_number() OVER (PARTITION BY {', '.join(VERSION_KEYS)}
                      ORDER BY known_at DESC, observed_at DESC, doc_id DESC) AS rn
          FROM v_metrics WHERE known_at <= '{DECISION}') x WHERE rn = 1""",
)
def pit_latest_fact(spark, sf_dir):
    metrics = adapters.statement_metrics(spark, sf_dir)
    stock = F.when(F.col("stock_code") != "", F.col("stock_code"))
    latest = pit.latest_fact(metrics.withColumn("stock_code", stock), DECISION)
    return report(latest.select(*VERSION_KEYS, "doc_id", "known_at", "observed_at"))


def _metric_versions(spark, sf_dir):
    """Metric rows as features, with the repeats and broken stamps of the sample data left in."""
    rows = adapters.statement_metrics(spark, sf_dir)
    written = times.iso_z(F.col("known_at"))
    known = F.when(F.col("l_broken"), F.concat(F.lit("?"), written)).otherwise(written)
    return (
        rows.withColumn("l_broken", F.col("row_b") == 7)
        .withColumn("known_at", known)
        .select(
            F.col("period_end").alias("date"),
            F.col("doc_id").alias("ticker"),
            F.col("metric").alias("feature"),
            F.col("numeric_value").alias("value"),
            "known_at",
            "observed_at",
        )
    )


@query(
    "pit_validate",
    """SELECT CAST(sum(CASE WHEN broken THEN n ELSE 0 END) AS BIGINT) AS bad_known_at,
       CAST(0 AS BIGINT) AS bad_observed_at, CAST(sum(n - 1) AS BIGINT) AS duplicate_versions
       FROM (SELECT period_end, doc_id, metric, known_at, observed_at, l_linenumber = 7 AS broken, count(*) AS n
             FROM v_metrics GROUP BY ALL) g""",
)
def pit_validate(spark, sf_dir):
    return quality.feature_violations(_metric_versions(spark, sf_dir))


@query(
    "qa_violations",
    """SELECT count(*) FILTER (WHERE numeric_value IS NULL) AS missing_value,
       count(*) FILTER (WHERE l_linenumber = 7) AS bad_known_at,
       count(*) FILTER (WHERE stock_code IS NULL) AS blank_ticker,
       count(*) FILTER (WHERE consolidation IS NULL AND relative_year IS NULL) AS no_context
       FROM v_metrics""",
)
def qa_violations(spark, sf_dir):
    rows = adapters.statement_metrics(spark, sf_dir)
    known = F.when(F.col("row_b") == 7, "not a stamp").otherwise(times.iso_z(F.col("known_at")))
    checks = {
        "missing_value": F.col("numeric_value").isNull(),
        "bad_known_at": times.to_utc(known).isNull(),
        "blank_ticker": F.trim("stock_code") == "",
        "no_context": F.col("consolidation").isNull() & F.col("relative_year").isNull(),
    }
    return quality.violations(rows, checks)


@query(
    "pit_known_date",
    f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS last_update,
        {iso("o_orderdate + INTERVAL 14 HOUR + INTERVAL 59 MINUTE + INTERVAL 59 SECOND")} AS known_at
        FROM orders""",
)
def pit_known_date(spark, sf_dir):
    code = F.date_format("o_orderdate", "yyyyMMdd")
    rows = adapters.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(times.update_day(code), "yyyy-MM-dd").alias("last_update"),
        times.known_from_update(code).alias("known_at"),
    )
    return report(rows)


@query(
    "pit_known_disclosure",
    f"""SELECT o_orderkey, {iso('''CASE
          WHEN o_orderstatus = 'O' THEN TIMESTAMP '2003-01-10 14:59:59'
          WHEN o_orderpriority = '1-URGENT' THEN o_orderdate + INTERVAL 6 HOUR + INTERVAL 30 MINUTE + INTERVAL 5 SECOND
          WHEN o_orderpriority = '2-HIGH' THEN o_orderdate + INTERVAL 5 MINUTE
          WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate + INTERVAL 6 HOUR + INTERVAL 30 MINUTE
          WHEN o_orderpriority = '4-NOT SPECIFIED'
            THEN o_orderdate + INTERVAL 6 HOUR + INTERVAL 30 MINUTE + INTERVAL 15 SECOND
          ELSE o_orderdate + INTERVAL 14 HOUR + INTERVAL 59 MINUTE + INTERVAL 59 SECOND END''')} AS known_at
        FROM orders""",
)
def pit_known_disclosure(spark, sf_dir):
    priority = F.col("o_orderpriority")
    time = (
        F.when(priority == "1-URGENT", "15:30:05")
        .when(priority == "2-HIGH", "9:05")
        .when(priority == "3-MEDIUM", "1530")
        .when(priority == "4-NOT SPECIFIED", "153015")
        .otherwise("nan")
    )
    day = F.when(F.col("o_orderstatus") != "O", adapters.day_text("o_orderdate")).otherwise("pending")
    known = times.known_from_disclosure(day, time, F.lit("2003-01-10"))
    return report(adapters.table(spark, sf_dir, "orders").select("o_orderkey", known.alias("known_at")))


@query(
    "pit_known_filing",
    f"""SELECT doc_id, {iso('''CASE
          WHEN doc_type_code = '999' THEN CAST(file_date AS TIMESTAMP) + INTERVAL 78 HOUR
          WHEN operated IS NOT NULL THEN operated - INTERVAL 9 HOUR
          ELSE CAST(file_date AS TIMESTAMP) + INTERVAL 1 HOUR END''')} AS known_at
        FROM v_documents""",
)
def pit_known_filing(spark, sf_dir):
    documents = adapters.document_list(spark, sf_dir)
    unusable = F.col("doc_type_code") == "999"
    known = times.known_from_filing(
        F.when(unusable, "unknown").otherwise(F.col("submit_datetime")),
        F.when(~unusable, F.col("operation_datetime")),
        times.to_utc(F.col("observed_at")),
    )
    return report(documents.select("doc_id", known.alias("known_at")))


def hashed(documents, cents):
    return documents.withColumn("record_sha256", F.sha2(F.concat_ws("|", "doc_id", cents.cast("string")), 256))


@query(
    "pit_changes_hash",
    f"""SELECT doc_id, seq_number, change_type,
        CASE WHEN change_type = 'new' THEN known_at
             WHEN operated IS NOT NULL THEN {iso('operated - INTERVAL 9 HOUR')} ELSE observed_at END AS known_at
        FROM (SELECT *, CASE WHEN doc_type_code = '120' THEN 'new' WHEN doc_type_code = '350' THEN 'revised' END
                        AS change_type FROM v_documents) x
        WHERE change_type IS NOT NULL""",
)
def pit_changes_hash(spark, sf_dir):
    """Yesterday's list lacked the annual reports and had other amounts for ownership reports."""
    documents = adapters.document_list(spark, sf_dir)
    earlier = documents.where(F.col("doc_type_code") != "120")
    revised = F.when(F.col("doc_type_code") == "350", F.col("cents") + 1).otherwise(F.col("cents"))
    changed = changes.filing_changes(hashed(documents, F.col("cents")), hashed(earlier, revised))
    return report(changed.select("doc_id", "seq_number", "change_type", "known_at"))


def _observations(spark, sf_dir):
    return adapters.table(spark, sf_dir, "events").select(
        F.lit("sample").alias("source_id"),
        F.col("event_type").alias("dataset"),
        F.lit("DB").alias("db"),
        F.col("user_id").cast("string").alias("series_id"),
        F.col("event_id").cast("string").alias("period_code"),
        F.col("value"),
        adapters.day_text("ts").alias("source_last_update"),
        adapters.stamp_text("ts").alias("known_at"),
        adapters.stamp_text(adapters.later("ts", 1)).alias("observed_at"),
    )


@query(
    "pit_changes_value",
    """SELECT event_type AS dataset, user_id::VARCHAR AS series_id, event_id::VARCHAR AS period_code,
       round(value, 6) AS value, CASE WHEN event_type = 'signup' THEN 'new' ELSE 'revised' END AS change_type
       FROM events WHERE event_type IN ('signup', 'purchase', 'error')""",
)
def pit_changes_value(spark, sf_dir):
    """Signups are new, purchases had another value, errors another update day."""
    current = _observations(spark, sf_dir)
    kind = F.col("dataset")
    noise = F.when(kind == "purchase", F.col("value") + 0.5).otherwise(F.col("value") + 1e-14)
    updated = F.when(kind == "error", F.lit(None).cast("string")).otherwise(F.col("source_last_update"))
    previous = current.where(kind != "signup").withColumns({"value": noise, "source_last_update": updated})
    changed = changes.series_changes(current, previous)
    return report(changed.select("dataset", "series_id", "period_code", "value", "change_type"), 6)


@query(
    "pit_rebuild",
    f"""SELECT doc_id, version, known_at FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY known_at DESC, observed_at DESC) AS rn
          FROM (SELECT doc_id, 'listed' AS version, known_at, observed_at FROM v_documents
                UNION ALL
                SELECT doc_id, 'operated', {iso('operated - INTERVAL 9 HOUR')}, observed_at
                FROM v_documents WHERE operated IS NOT NULL) u
          WHERE known_at <= '{DECISION}') x WHERE rn = 1""",
)
def pit_rebuild(spark, sf_dir):
    documents = adapters.document_list(spark, sf_dir)
    listed = documents.select("doc_id", F.lit("listed").alias("version"), "known_at", "observed_at")
    operated = documents.where(F.col("operation_datetime").isNotNull()).select(
        "doc_id",
        F.lit("operated").alias("version"),
        times.iso_z(times.jst_text(F.col("operation_datetime"))).alias("known_at"),
        "observed_at",
    )
    return pit.rebuild_state([listed, operated], DECISION, ["doc_id"]).select("doc_id", "version", "known_at")


def _record_json() -> str:
    """The record as JSON text in the view's columns; fields the sample lacks are null."""
    have = {c: c for c in ("seq_number", "doc_id", "doc_type_code", "csv_flag", "submit_datetime")}
    have["operation_datetime"] = "strftime(operated, '%Y-%m-%dT%H:%M:%S')"
    cells = [f'"{f}" := {have.get(c, "NULL::VARCHAR")}' for f, c in sorted(v.FILING_FIELDS.items())]
    return f"CAST(to_json(struct_pack({', '.join(cells)})) AS VARCHAR)"


@query("pit_record_hash", f"SELECT doc_id, sha256({_record_json()}) AS record_sha256 FROM v_documents")
def pit_record_hash(spark, sf_dir):
    """Canonical hash over the 29 provider fields; fields the sample lacks are null."""
    documents = adapters.document_list(spark, sf_dir)
    have = {f: c for f, c in v.FILING_FIELDS.items() if c in documents.columns}
    record = documents.select(
        "doc_id",
        *[(F.col(have[f]) if f in have else F.lit(None).cast("string")).alias(f) for f in v.FILING_FIELDS],
    )
    return record.select("doc_id", changes.record_hash(list(v.FILING_FIELDS)).alias("record_sha256"))


@query(
    "ftr_ownership",
    f"""SELECT date, issuer_stock_code AS ticker, 'ownership_ratio_change' AS feature, round(change, 8) AS value,
        known_at, observed_at, doc_id AS source_doc_id, holder_name FROM ({OWNERSHIP_PICK}) p""",
)
def ftr_ownership(spark, sf_dir):
    rows = adapters.ownership_rows(spark, sf_dir)
    return report(ownership_features(rows, adapters.FACT_ROW_ORDER), 8)


def previous_forecasts(source: str) -> str:
    """Last explicit forecast of each metric before each row of a disclosure view."""
    order = "known_at, observed_at, disc_no, disc_date, f1, f2, f3, f4, f5"
    lasts = ", ".join(f"last_value(f{i} IGNORE NULLS) OVER w AS p{i}" for i in range(1, 6))
    return (
        f"SELECT *, {lasts}, count(*) OVER w AS seen FROM {source} WINDOW w AS (PARTITION BY ticker, fy "
        f"ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )


REVISION_ROW = """disc_date AS date, ticker, {name} AS feature, round({value}, 8) AS value, known_at, observed_at,
       fy AS source_fiscal_year_end, disc_no AS source_disc_no"""


def revision_pct(source: str) -> str:
    parts = []
    for i, name in enumerate(v.FORECAST_FEATURES.values(), start=1):
        row = REVISION_ROW.format(name=f"'{name}'", value=f"(f{i} - p{i}) / abs(p{i})")
        parts.append(f"SELECT {row} FROM ({previous_forecasts(source)}) q WHERE f{i} IS NOT NULL AND p{i} <> 0")
    return "\nUNION ALL\n".join(parts)


def revision_breadth(source: str) -> str:
    total = " + ".join(f"coalesce(sign(f{i} - p{i}), 0)" for i in range(1, 6))
    known = " + ".join(f"(CASE WHEN f{i} - p{i} IS NULL THEN 0 ELSE 1 END)" for i in range(1, 6))
    row = REVISION_ROW.format(name=f"'{v.BREADTH_FEATURE}'", value=f"({total})::DOUBLE / ({known})")
    return f"SELECT {row} FROM ({previous_forecasts(source)}) q WHERE ({known}) > 0 AND seen > 0"


@query("ftr_revision_pct", revision_pct("v_forecast"))
def ftr_revision_pct(spark, sf_dir):
    features = forecast_revisions(adapters.forecast_summary(spark, sf_dir))
    return report(features.where(F.col("feature") != v.BREADTH_FEATURE), 8)


@query("ftr_revision_breadth", revision_breadth("v_forecast"))
def ftr_revision_breadth(spark, sf_dir):
    features = forecast_revisions(adapters.forecast_summary(spark, sf_dir))
    return report(features.where(F.col("feature") == v.BREADTH_FEATURE), 8)


_HALF = "2000-01-01"
ADVANCING = """(SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, fy, known_at
              ORDER BY observed_at, disc_no, disc_date, f1, f2, f3, f4, f5) AS rn
  FROM v_forecast) z WHERE rn = 1) adv"""


@query(
    "str_revision_batch",
    f"""SELECT * FROM ({revision_pct(ADVANCING)}
        UNION ALL {revision_breadth(ADVANCING)}) r WHERE date >= '{_HALF}'""",
)
def str_revision_batch(spark, sf_dir):
    """Two incremental runs; the second sees the first half again and must skip it."""
    summary = adapters.forecast_summary(spark, sf_dir)
    _, state = forecast_revisions_with_state(summary.where(F.col("DiscDate") < _HALF))
    ensure_checkpoint_dir(spark)
    # Between two runs the state is a stored table.
    features, _ = forecast_revisions_with_state(summary, state.checkpoint())
    return report(features, 8)


@query(
    "ftr_catalog",
    f"""SELECT c.feature, c.higher_is_better, c.source_datasets, c.description, count(*) AS rows,
        round(sum(CASE WHEN c.higher_is_better = 'true' THEN p.numeric_value ELSE -p.numeric_value END), 2) AS oriented_sum
        FROM (VALUES {', '.join(f"('{n}', '{str(h).lower()}', '{','.join(d)}', '{t}')" for n, h, d, t in v.FEATURE_CATALOG)})
             c(feature, higher_is_better, source_datasets, description)
        JOIN (SELECT CASE metric WHEN 'net_income' THEN 'roe' WHEN 'interest_bearing_debt' THEN 'net_debt'
                     WHEN 'cash_and_deposits' THEN 'amihud_20d' WHEN 'net_assets' THEN 'forecast_revision_breadth' END
                     AS feature, numeric_value FROM v_metrics WHERE numeric_value IS NOT NULL) p USING (feature)
        GROUP BY 1, 2, 3, 4""",
)
def ftr_catalog(spark, sf_dir):
    named = {
        "net_income": "roe",
        "interest_bearing_debt": "net_debt",
        "cash_and_deposits": "amihud_20d",
        "net_assets": "forecast_revision_breadth",
    }
    feature = F.coalesce(*[F.when(F.col("metric") == m, F.lit(n)) for m, n in named.items()])
    rows = adapters.statement_metrics(spark, sf_dir).select(feature.alias("feature"), F.col("numeric_value").alias("value"))
    oriented = orient_features(rows.dropna()).groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("oriented_value").alias("oriented_sum")
    )
    catalog = feature_catalog(spark).withColumn("source_datasets", F.concat_ws(",", "source_datasets"))
    return report(catalog.join(oriented, "feature"), 2)
