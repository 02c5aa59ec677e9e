"""Queries over bars, labels, cross-sections, portfolios and universes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import cross_section as xs
from tidemark.operators import entities, market
from tidemark.plans import adapters, research
from tidemark.plans.oracle_views import day, padded, quantile, security, stamp
from tidemark.plans.registry import query, report


@query(
    "ftr_bars",
    f"""SELECT ticker, {day('dt')} AS date, round(ln(price), 9) AS log_price, round(va, 4) AS trading_value,
        {stamp('dt')} AS known_at, {stamp('dt + INTERVAL 84 DAY')} AS observed_at FROM v_bars""",
)
def ftr_bars(spark, sf_dir):
    bars = market.prepare_bars(adapters.bars(spark, sf_dir))
    out = bars.withColumns(
        {
            "date": F.date_format("date", "yyyy-MM-dd"),
            "log_price": F.round(F.ln("price"), 9),
            "trading_value": F.round("trading_value", 4),
        }
    )
    return report(out.drop("price"))


def _feature(spark, sf_dir, name, places):
    return report(market.market_features(adapters.bars(spark, sf_dir), features=[name]), places)


@query(
    "ftr_momentum",
    f"""SELECT {day('dt')} AS date, ticker, 'momentum_12_1' AS feature, round(momentum, 8) AS value,
        {stamp('momentum_dt')} AS known_at, {stamp('momentum_dt + INTERVAL 84 DAY')} AS observed_at
        FROM v_market WHERE momentum IS NOT NULL""",
)
def ftr_momentum(spark, sf_dir):
    return _feature(spark, sf_dir, "momentum_12_1", 8)


@query(
    "ftr_amihud",
    f"""SELECT {day('dt')} AS date, ticker, 'amihud_20d' AS feature, round(amihud, 12) AS value,
        {stamp('dt')} AS known_at, {stamp('window_dt + INTERVAL 84 DAY')} AS observed_at
        FROM v_liquidity WHERE n_illiq = 20""",
)
def ftr_amihud(spark, sf_dir):
    return _feature(spark, sf_dir, "amihud_20d", 12)


@query(
    "ftr_avg_value",
    f"""SELECT {day('dt')} AS date, ticker, 'avg_trading_value_20d' AS feature, round(mean_value, 6) AS value,
        {stamp('dt')} AS known_at, {stamp('window_dt + INTERVAL 84 DAY')} AS observed_at
        FROM v_liquidity WHERE n_value = 20""",
)
def ftr_avg_value(spark, sf_dir):
    return _feature(spark, sf_dir, "avg_trading_value_20d", 6)


@query(
    "ftr_forward_returns",
    f"""SELECT {day('dt')} AS date, ticker, h AS horizon_trading_days, round(forward_return, 8) AS forward_return,
        {stamp('dt')} AS decision_known_at, {stamp('outcome_dt')} AS outcome_known_at,
        {stamp('outcome_dt + INTERVAL 84 DAY')} AS outcome_observed_at
        FROM v_labels WHERE forward_return IS NOT NULL""",
)
def ftr_forward_returns(spark, sf_dir):
    return report(market.forward_returns(adapters.bars(spark, sf_dir)), 8)


@query(
    "jon_labels",
    f"""SELECT m.ticker, {day('m.dt')} AS date, round(m.momentum, 8) AS value, l.h AS horizon_trading_days,
        round(l.forward_return, 8) AS forward_return
        FROM v_market m JOIN v_labels l ON m.ticker = l.ticker AND m.dt = l.dt
        WHERE m.momentum IS NOT NULL AND l.forward_return IS NOT NULL
          AND m.momentum_dt <= m.dt AND m.dt < l.outcome_dt""",
)
def jon_labels(spark, sf_dir):
    beside = market.momentum_with_returns(adapters.bars(spark, sf_dir))
    paired = xs.known_pairs(beside.select("*", F.inline("ahead")))
    return report(paired.select("ticker", "date", "value", "horizon_trading_days", "forward_return"), 8)


@query(
    "xsa_momentum_spread",
    f"""SELECT date, round(max_by(mean_return, quantile) - min_by(mean_return, quantile), 6) AS long_short_return
        FROM (SELECT {day('q.dt')} AS date, q.quantile, avg(l.forward_return) AS mean_return
              FROM (SELECT ticker, dt, momentum_dt, {quantile('rk', 'n', 5)} AS quantile
                    FROM (SELECT *, row_number() OVER (PARTITION BY dt ORDER BY momentum, ticker) AS rk,
                                 count(*) OVER (PARTITION BY dt) AS n
                          FROM v_market WHERE momentum IS NOT NULL) r
                    WHERE n >= 5) q
              JOIN v_labels l ON q.ticker = l.ticker AND q.dt = l.dt
              WHERE l.h = 21 AND l.forward_return IS NOT NULL AND q.momentum_dt <= q.dt AND q.dt < l.outcome_dt
              GROUP BY 1, 2) m
        GROUP BY 1""",
)
def xsa_momentum_spread(spark, sf_dir):
    return report(research.momentum_spread(adapters.bars(spark, sf_dir)), 6)


@query(
    "xsa_quantiles",
    """SELECT date, ticker, CAST(coalesce(quantile, 0) AS BIGINT) AS quantile,
       CAST(coalesce(quantile_down, 0) AS BIGINT) AS quantile_down FROM v_buckets""",
)
def xsa_quantiles(spark, sf_dir):
    panel = adapters.panel(spark, sf_dir)
    up = xs.assign_quantiles(panel)
    both = xs.assign_quantiles(up, n_quantiles=10, high_is_good=False, output="quantile_down")
    labels = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("quantile", "quantile_down")]
    return both.select("date", "ticker", *labels)


@query(
    "xsa_summary",
    """SELECT date, CAST(quantile AS BIGINT) AS quantile, count(forward_return) AS count,
       round(avg(forward_return), 8) AS mean_return, round(median(forward_return), 8) AS median_return
       FROM v_buckets WHERE quantile IS NOT NULL GROUP BY 1, 2""",
)
def xsa_summary(spark, sf_dir):
    summary = xs.quantile_summary(xs.assign_quantiles(adapters.panel(spark, sf_dir)))
    return report(summary.withColumn("quantile", F.col("quantile").cast("long")), 8)


@query(
    "xsa_spread",
    """SELECT date, round(max_by(m, quantile) - min_by(m, quantile), 8) AS long_short_return
       FROM (SELECT date, quantile, avg(forward_return) AS m FROM v_buckets
             WHERE quantile IS NOT NULL GROUP BY 1, 2) x GROUP BY 1""",
)
def xsa_spread(spark, sf_dir):
    summary = xs.quantile_summary(xs.assign_quantiles(adapters.panel(spark, sf_dir)))
    return report(xs.long_short_spread(summary), 8)


@query(
    "xsa_neutralize",
    """SELECT p.date, p.ticker, round(s.score, 6) AS neutralized_factor
       FROM v_panel p LEFT JOIN (
         SELECT date, ticker, e / scale AS score
         FROM (SELECT *, stddev_pop(e) OVER (PARTITION BY date) AS scale
               FROM (SELECT *, yd - xd * coalesce(sum(xd * yd) OVER d / nullif(sum(xd * xd) OVER d, 0), 0) AS e,
                            count(*) OVER d AS n, count(DISTINCT sector) OVER d AS k,
                            sqrt(sum(yd * yd) OVER d / count(*) OVER d) AS spread
                     FROM (SELECT *, factor - avg(factor) OVER (PARTITION BY date, sector) AS yd,
                                  ln(market_cap) - avg(ln(market_cap)) OVER (PARTITION BY date, sector) AS xd
                           FROM v_panel WHERE market_cap > 0) c
                     WINDOW d AS (PARTITION BY date)) r) t
         WHERE n >= 10 AND n > k + 1 AND scale > 1e-12 * greatest(1, spread)) s
       ON p.date = s.date AND p.ticker = s.ticker""",
)
def xsa_neutralize(spark, sf_dir):
    scored = xs.neutralize(adapters.panel(spark, sf_dir))
    return report(scored.select("date", "ticker", "neutralized_factor"), 6)


@query("xsa_turnover", "SELECT date, round(turnover, 8) AS turnover FROM v_turnover")
def xsa_turnover(spark, sf_dir):
    return report(xs.portfolio_turnover(adapters.weights(spark, sf_dir)), 8)


@query(
    "xsa_costs",
    """SELECT r.date, round(r.gross_return, 8) AS gross_return, round(t.turnover, 8) AS turnover,
       round(t.turnover * 0.001, 8) AS transaction_cost,
       round(r.gross_return - t.turnover * 0.001, 8) AS net_return
       FROM (SELECT date, avg(forward_return) AS gross_return FROM v_panel GROUP BY 1) r
       LEFT JOIN v_turnover t ON r.date = t.date""",
)
def xsa_costs(spark, sf_dir):
    returns = adapters.panel(spark, sf_dir).groupBy("date").agg(F.avg("forward_return").alias("gross_return"))
    turnover = xs.portfolio_turnover(adapters.weights(spark, sf_dir))
    return report(xs.apply_costs(returns, turnover), 8)


@query("jon_universe", "SELECT * FROM v_universe WHERE market_code IN ('01', '02', '03', '010', '011', '012')")
def jon_universe(spark, sf_dir):
    master = adapters.listing_master(spark, sf_dir)
    return report(entities.universe_snapshot(master, allowed_markets=["01", "02", "03", "010", "011", "012"]))


@query(
    "jon_universe_filter",
    f"""SELECT b.ticker, {day('b.dt')} AS date, round(ln(b.price), 9) AS log_price FROM v_bars b
        WHERE EXISTS (SELECT 1 FROM v_universe u
                      WHERE u.ticker = b.ticker AND u.date = {day('b.dt')} AND u.product_category = '011')""",
)
def jon_universe_filter(spark, sf_dir):
    master = adapters.listing_master(spark, sf_dir)
    universe = entities.universe_snapshot(master, allowed_product_categories=["011"])
    bars = market.prepare_bars(adapters.bars(spark, sf_dir))
    members = entities.filter_to_universe(bars, universe)
    return report(
        members.select("ticker", F.date_format("date", "yyyy-MM-dd").alias("date"), F.ln("price").alias("log_price")), 9
    )


@query(
    "jon_latest",
    """SELECT ticker, market_code, company_name, known_at, observed_at FROM (
         SELECT *, row_number() OVER (PARTITION BY ticker
                     ORDER BY known_at DESC, observed_at DESC, company_name DESC) AS rn FROM v_master) x
       WHERE rn = 1""",
)
def jon_latest(spark, sf_dir):
    latest = entities.latest_by_ticker(adapters.listing_master(spark, sf_dir), "Code", ["CoName"])
    return report(
        latest.select("ticker", F.col("Mkt").alias("market_code"), F.col("CoName").alias("company_name"), "known_at", "observed_at")
    )


@query(
    "jon_identifier_map",
    f"""SELECT coalesce(e.ticker, q.ticker) AS ticker, e.sec_code, q.sec_code AS jquants_code,
        e.edinet_code, coalesce(q.name, e.name) AS company_name, e.name AS edinet_filer_name,
        q.name AS jquants_company_name, greatest(e.known_at, q.known_at) AS known_at,
        greatest(e.observed_at, q.observed_at) AS observed_at,
        CASE WHEN e.sec_code IS NULL OR q.sec_code IS NULL THEN NULL
             WHEN upper(e.sec_code) = upper(q.sec_code) THEN 'true' ELSE 'false' END AS code_match
        FROM (SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY o_orderdate DESC, sec_code DESC, edinet_code || '.0' DESC, name DESC) AS rn
                FROM (SELECT *, CASE WHEN length(sec_code) = 4 THEN sec_code
                                     WHEN length(sec_code) = 5 AND right(sec_code, 1) = '0' THEN left(sec_code, 4) END AS ticker
                      FROM (SELECT o_orderdate, CASE WHEN o_orderstatus = 'F' THEN {padded('o_custkey', 4)}
                                                     ELSE {padded('o_custkey', 4)} || '0' END AS sec_code,
                                   'E' || o_custkey::VARCHAR AS edinet_code, 'Filer ' || o_orderkey::VARCHAR AS name,
                                   {stamp('o_orderdate')} AS known_at, {stamp("o_orderdate + INTERVAL 1 DAY")} AS observed_at
                            FROM orders) x) y
                WHERE ticker IS NOT NULL) z WHERE rn = 1) e
        FULL OUTER JOIN (SELECT {security('s_suppkey')} AS ticker,
                     {security('s_suppkey')} || '0' AS sec_code, s_name AS name,
                     '1998-01-01T06:00:00Z' AS known_at, '1998-03-26T06:00:00Z' AS observed_at FROM supplier) q
        ON e.ticker = q.ticker""",
)
def jon_identifier_map(spark, sf_dir):
    key = F.col("o_custkey").cast("string")
    short = adapters.padded("o_custkey", 4)
    filers = adapters.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", short).otherwise(F.concat(short, F.lit("0"))).alias("sec_code"),
        F.concat(F.lit("E"), key, F.lit(".0")).alias("edinet_code"),
        F.concat(F.lit(" Filer "), F.col("o_orderkey").cast("string")).alias("filer_name"),
        adapters.stamp_text("o_orderdate").alias("known_at"),
        adapters.stamp_text(adapters.later("o_orderdate", 1)).alias("observed_at"),
    )
    listings = adapters.table(spark, sf_dir, "supplier").select(
        F.concat(adapters.security("s_suppkey"), F.lit("0")).alias("Code"),
        F.col("s_name").alias("CoName"),
        F.lit("1998-01-01T06:00:00Z").alias("known_at"),
        F.lit("1998-03-26T06:00:00Z").alias("observed_at"),
    )
    return report(entities.identifier_map(filers, listings))


@query(
    "xsa_research_chain",
    f"""SELECT date, round(max_by(m, quantile) - min_by(m, quantile), 6) AS long_short_return
        FROM (SELECT date, quantile, avg(forward_return) AS m
              FROM (SELECT *, {quantile('rk', 'n', 5)} AS quantile
                    FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY score, ticker) AS rk, count(*) OVER (PARTITION BY date) AS n
                          FROM (SELECT *, e / scale AS score
                                FROM (SELECT *, stddev_pop(e) OVER (PARTITION BY date) AS scale
                                      FROM (SELECT *, count(*) OVER d AS rows, count(DISTINCT sector) OVER d AS sectors,
                                                   sqrt(sum(yd * yd) OVER d / count(*) OVER d) AS spread,
                                                   yd - xd * coalesce(sum(xd * yd) OVER d / nullif(sum(xd * xd) OVER d, 0), 0) AS e
                                            FROM (SELECT *, value - avg(value) OVER (PARTITION BY date, sector) AS yd,
                                                         ln(market_cap) - avg(ln(market_cap)) OVER (PARTITION BY date, sector) AS xd
                                                  FROM v_research WHERE listed AND market_cap > 0) c
                                            WINDOW d AS (PARTITION BY date)) r) t
                                WHERE rows >= 10 AND rows > sectors + 1 AND scale > 1e-12 * greatest(1, spread)) z) k
                    WHERE n >= 5) q
              WHERE NOT late AND sector <> 'FURNITURE' GROUP BY 1, 2) x GROUP BY 1""",
)
def xsa_research_chain(spark, sf_dir):
    """Universe, neutralisation by sector and size, buckets, labels after the decision, spread."""
    features, labels, exposures, master = adapters.research_inputs(spark, sf_dir)
    universe = entities.universe_snapshot(master)
    return report(research.factor_spread(features, labels, universe=universe, exposures=exposures), 6)
