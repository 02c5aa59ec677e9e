"""SQL views over the sample tables, for checking results with an independent engine."""

from __future__ import annotations

from tidemark import vocabulary as v
from tidemark.operators.cross_section import quantile_levels
from tidemark.plans.adapters import FACT_ELEMENTS, REPORT_ELEMENTS


def day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def stamp(expr: str, clock: str = "06:00:00") -> str:
    return f"strftime({expr}, '%Y-%m-%dT{clock}Z')"


def iso(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%SZ')"


def pick(options, key: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(options))
    return f"(CASE ({key}) % {len(options)} {cases} END)"


def padded(key: str, width: int) -> str:
    """A key as text, filled with zeros and never shortened."""
    return f"lpad({key}::VARCHAR, greatest(length({key}::VARCHAR), {width})::INTEGER, '0')"


def security(key: str) -> str:
    """The four-character code of a number; see ``adapters.security``."""
    above = f"({key}::BIGINT - 10000 + {10 * 36**3})"
    letters = " || ".join(f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', ({above} // {36**k} % 36 + 1)::INTEGER, 1)" for k in (3, 2, 1, 0))
    return f"(CASE WHEN {key} < 10000 THEN {padded(key, 4)} WHEN {above} < {36**4} THEN {letters} ELSE error('no code left') END)"


def quantile(rank: str, size: str, n_quantiles: int) -> str:
    """Bucket of a rank; the same edges as the percentile grid of 1..size."""
    terms = []
    for level in quantile_levels(n_quantiles):
        pos = f"(({size} - 1)::DOUBLE * {level!r}::DOUBLE)"
        rest = f"({pos} - floor({pos}))"
        edge = (
            f"(CASE WHEN {rest} < 0.5::DOUBLE THEN (floor({pos}) + 1::DOUBLE) + {rest} "
            f"ELSE (floor({pos}) + 2::DOUBLE) - (1::DOUBLE - {rest}) END)"
        )
        terms.append(f"(CASE WHEN {rank} > {edge} THEN 1 ELSE 0 END)")
    return "(1 + " + " + ".join(terms) + ")"


ROW_ORDER = "l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice"
PART_CODE = padded("l_partkey", 5)
REPORT_ELEMENT = pick(REPORT_ELEMENTS, "l_suppkey + l_partkey")
PERCENT = "CAST(round(l_discount * 100) AS INTEGER)::VARCHAR"

VIEWS = {
    "v_bars": f"""
SELECT {security('l_suppkey')} AS ticker, CAST(l_shipdate AS DATE) AS dt,
       sum(l_extendedprice) / sum(l_quantity) AS price, sum(l_extendedprice) AS va
FROM lineitem GROUP BY 1, 2""",
    "v_market": """
SELECT *, price / lag(price) OVER w - 1 AS ret,
       lag(price, 21) OVER w / lag(price, 252) OVER w - 1 AS momentum,
       lag(dt, 21) OVER w AS momentum_dt
FROM v_bars WINDOW w AS (PARTITION BY ticker ORDER BY dt)""",
    "v_liquidity": """
SELECT *, count(abs(ret) / va) OVER f AS n_illiq, avg(abs(ret) / va) OVER f AS amihud,
       count(va) OVER f AS n_value, avg(va) OVER f AS mean_value, max(dt) OVER f AS window_dt
FROM v_market WINDOW f AS (PARTITION BY ticker ORDER BY dt ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "v_labels": """
SELECT ticker, dt, 21 AS h, lead(price, 21) OVER w / price - 1 AS forward_return, lead(dt, 21) OVER w AS outcome_dt
FROM v_bars WINDOW w AS (PARTITION BY ticker ORDER BY dt)
UNION ALL
SELECT ticker, dt, 63 AS h, lead(price, 63) OVER w / price - 1 AS forward_return, lead(dt, 63) OVER w AS outcome_dt
FROM v_bars WINDOW w AS (PARTITION BY ticker ORDER BY dt)""",
    "v_panel": """
SELECT strftime(o_orderdate, '%Y-%m') AS date, o_custkey::VARCHAR AS ticker, c_mktsegment AS sector,
       c_acctbal AS market_cap, avg(o_totalprice) AS factor, avg(o_totalprice % 100) / 1000 AS forward_return
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4""",
    "v_ranked": """
SELECT *, row_number() OVER (PARTITION BY date ORDER BY factor, ticker) AS rk,
       row_number() OVER (PARTITION BY date ORDER BY -factor, ticker) AS rk_down,
       count(*) OVER (PARTITION BY date) AS n
FROM v_panel""",
    "v_buckets": f"""
SELECT *, CASE WHEN n >= 5 THEN {quantile('rk', 'n', 5)} END AS quantile,
       CASE WHEN n >= 10 THEN {quantile('rk_down', 'n', 10)} END AS quantile_down
FROM v_ranked""",
    "v_research": f"""
SELECT strftime(o_orderdate, '%Y-%m-01') AS date, {security('o_custkey')} AS ticker, c_mktsegment AS sector, c_acctbal AS market_cap,
       avg(o_totalprice) AS value, avg(o_totalprice % 100) / 1000 AS forward_return,
       bool_or(o_orderpriority <> '5-LOW') AS listed, o_custkey % 7 = 0 AS late
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3, 4, o_custkey""",
    "v_weights": """
SELECT date, ticker, amount / sum(amount) OVER (PARTITION BY date) AS weight
FROM (SELECT strftime(o_orderdate, '%Y-%m') AS date, c_nationkey::VARCHAR || '-' || c_mktsegment AS ticker,
             sum(o_totalprice) AS amount
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) a""",
    "v_turnover": """
SELECT date, CASE WHEN date <> (SELECT min(date) FROM v_weights) THEN turnover END AS turnover
FROM (SELECT date, 0.5 * sum(abs(change)) AS turnover
      FROM (SELECT date, ticker, sum(w) AS change
            FROM (SELECT date, ticker, weight AS w FROM v_weights
                  UNION ALL
                  SELECT d.next_date, w.ticker, -w.weight
                  FROM v_weights w
                  JOIN (SELECT date, lead(date) OVER (ORDER BY date) AS next_date
                        FROM (SELECT DISTINCT date FROM v_weights) x) d USING (date)
                  WHERE d.next_date IS NOT NULL) m
            GROUP BY 1, 2) c
      GROUP BY 1) t""",
    "v_metrics": f"""
SELECT 'S' || {PART_CODE} AS doc_id,
       CASE WHEN l_returnflag <> 'R' THEN {PART_CODE} END AS stock_code,
       {pick(["120", "130", "140"], "l_partkey")} AS doc_type_code,
       {day('l_shipdate')} AS period_end, {stamp('l_shipdate')} AS known_at,
       {stamp("l_shipdate + INTERVAL 1 DAY")} AS observed_at,
       {pick(v.RATIO_METRICS, 'l_suppkey')} AS metric,
       CASE WHEN l_quantity > 2 THEN l_extendedprice END AS numeric_value,
       CASE l_returnflag WHEN 'A' THEN 'CurrentYear' WHEN 'N' THEN 'Prior1Year' END AS relative_year,
       CASE WHEN l_linestatus = 'O' THEN '連結' WHEN l_linenumber < 5 THEN 'NonConsolidated' END AS consolidation,
       CASE WHEN l_linenumber < 3 THEN 'instant' WHEN l_linenumber < 6 THEN 'duration' END AS period_type,
       'Context' || l_linenumber::VARCHAR AS context_id,
       CASE WHEN l_linenumber < 6 THEN 'JPY' END AS unit,
       l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice
FROM lineitem""",
    "v_ownership": f"""
SELECT l_orderkey::VARCHAR AS doc_id, {padded('l_orderkey', 6)} AS issuer_stock_code,
       CASE WHEN l_linestatus = 'F' THEN {day('l_shipdate')} END AS filing_date,
       {stamp('l_shipdate')} AS known_at, {stamp("l_shipdate + INTERVAL 2 DAY")} AS observed_at,
       'Holder ' || l_suppkey::VARCHAR AS holder_name, l_discount AS holding_ratio,
       CASE WHEN l_quantity > 5 THEN l_tax END AS previous_holding_ratio,
       CASE WHEN l_returnflag = 'A' THEN l_discount - l_tax END AS holding_ratio_change,
       l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice
FROM lineitem""",
    "v_forecast": f"""
SELECT {padded('c_nationkey', 3)} || substr(c_mktsegment, 1, 1) AS ticker,
       year(o_orderdate)::VARCHAR || '-03-31' AS fy, {day('o_orderdate')} AS disc_date,
       {padded('o_orderkey', 10)} AS disc_no,
       o_totalprice AS f1,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 0.1::DOUBLE END AS f2,
       CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 0.08::DOUBLE END AS f3,
       CASE WHEN o_orderstatus <> 'O' THEN o_totalprice - 250000 END AS f4,
       CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 100000) END AS f5,
       {stamp('o_orderdate', '06:30:00')} AS known_at,
       {stamp("o_orderdate + INTERVAL 84 DAY")} AS observed_at
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "v_facts": f"""
SELECT 'S' || l_partkey::VARCHAR AS doc_id, {pick(FACT_ELEMENTS, 'l_suppkey + l_partkey')} AS local_name,
       'item ' || l_returnflag AS item_name, 'Context' || l_linenumber::VARCHAR AS context_id,
       CASE WHEN l_linenumber < 6 THEN 'JPY' END AS unit,
       CASE WHEN l_returnflag <> 'R' THEN 'filer' END AS filer_name,
       CASE WHEN l_linestatus = 'O' THEN {day('l_shipdate')} END AS submit_datetime,
       CASE WHEN l_returnflag = 'A' THEN '△1,' || {padded('l_linenumber', 3)}
            WHEN l_returnflag = 'N' THEN '(' || l_partkey::VARCHAR || ')'
            WHEN l_linenumber < 3 THEN l_partkey::VARCHAR || '%'
            WHEN l_linenumber < 5 THEN '－'
            ELSE '1.5e' || l_linenumber::VARCHAR END AS raw_value,
       CASE WHEN l_returnflag = 'A' THEN -(1000 + l_linenumber)::DOUBLE
            WHEN l_returnflag = 'N' THEN -l_partkey::DOUBLE
            WHEN l_linenumber < 3 THEN l_partkey::DOUBLE
            WHEN l_linenumber < 5 THEN NULL
            ELSE 1.5::DOUBLE * pow(10, l_linenumber) END AS numeric_value,
       CASE WHEN l_returnflag = 'A' THEN 1
            WHEN l_returnflag = 'N' THEN 0
            WHEN l_linenumber < 3 THEN 1
            WHEN l_linenumber < 5 THEN 0 ELSE 1 END AS looks_numeric,
       l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice
FROM lineitem""",
    "v_aliases": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{m}')" for m, names in v.METRIC_ALIASES.items() for a in names)
    + ") t(local_name, metric)",
    "v_report": f"""
SELECT l_orderkey::VARCHAR AS doc_id, CASE WHEN l_orderkey < 5000 THEN '350' ELSE '360' END AS doc_type_code,
       {REPORT_ELEMENT} AS local_name,
       CASE WHEN l_linenumber < 7 THEN 'Holder' || l_linenumber::VARCHAR END AS context_id,
       CASE WHEN {REPORT_ELEMENT} = 'DocumentTitleCoverPage'
              THEN CASE WHEN l_linenumber < 4 THEN '変更報告書' ELSE '訂正報告書' END
            WHEN starts_with({REPORT_ELEMENT}, 'HoldingRatio') THEN {PERCENT} || '％'
            WHEN starts_with({REPORT_ELEMENT}, 'TotalNumber') THEN '1,' || lpad({PERCENT}, 3, '0')
            WHEN l_returnflag <> 'R' THEN 'text ' || l_partkey::VARCHAR END AS val,
       {day('l_shipdate')} AS submit_datetime,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_extendedprice) AS ord
FROM lineitem""",
    "v_documents": f"""
SELECT {day('o_orderdate')} AS file_date, o_orderkey AS seq_number,
       'S' || {padded('o_orderkey', 9)} AS doc_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN '120' WHEN '2-HIGH' THEN '350' WHEN '3-MEDIUM' THEN '180'
            WHEN '4-NOT SPECIFIED' THEN '220' ELSE '999' END AS doc_type_code,
       CASE WHEN o_orderstatus = 'P' THEN '0' ELSE '1' END AS csv_flag,
       {day('o_orderdate')} || ' 10:00' AS submit_datetime,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 1 DAY + INTERVAL 11 HOUR END AS operated,
       {stamp('o_orderdate', '01:00:00')} AS known_at, {stamp("o_orderdate + INTERVAL 3 DAY")} AS observed_at,
       CAST(round(o_totalprice * 100) AS BIGINT) AS cents
FROM orders""",
    "v_rules": "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', '{n}', {p}, {str(d).lower()})" for n, (codes, p, d) in v.DOCUMENT_RULES.items() for c in codes)
    + ") t(doc_type_code, category, priority, download_csv)",
    "v_master": f"""
SELECT month || '-01' AS date, {security('s_suppkey')} AS ticker,
       {security('s_suppkey')} || '0' AS jquants_code, s_name || ' ' || l_linestatus AS company_name,
       '0' || s_nationkey::VARCHAR AS market_code, 'Market ' || s_nationkey::VARCHAR AS market_name,
       CASE WHEN s_acctbal > 0 THEN '011' END AS product_category,
       {stamp('last_ship')} AS known_at, {stamp("last_ship + INTERVAL 84 DAY")} AS observed_at
FROM (SELECT l_suppkey, strftime(l_shipdate, '%Y-%m') AS month, l_linestatus, max(l_shipdate) AS last_ship
      FROM lineitem GROUP BY 1, 2, 3) x JOIN supplier ON l_suppkey = s_suppkey""",
    "v_universe": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY date, ticker
              ORDER BY known_at DESC, observed_at DESC, jquants_code DESC, company_name DESC) AS rn
  FROM v_master) x WHERE rn = 1""",
}
