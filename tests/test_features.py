import pytest
from pyspark.sql import functions as F

from tidemark.operators import financial, forecast, market, ownership, pit, quality

STAMPS = ("2024-05-10T06:00:00Z", "2024-05-10T07:00:00Z")
METRICS = "doc_id string, stock_code string, period_end string, known_at string, observed_at string, metric string, numeric_value double, relative_year string, consolidation string, period_type string, n int"


def filing(spark, values, doc="D1"):
    rows = []
    for i, (metric, value, *context) in enumerate(values):
        year, scope, period = (*context, None, None, None)[:3]
        rows.append((doc, "72030", "2024-03-31", *STAMPS, metric, value, year, scope, period, i))
    return spark.createDataFrame(rows, METRICS)


def ratios(spark, values):
    return {r.feature: r.value for r in financial.financial_features(filing(spark, values), ["n"]).collect()}


def test_ratios(spark):
    got = ratios(spark, [
        ("net_income", 999.0, "Prior1Year", "Consolidated", "Duration"),
        ("net_income", 555.0, "CurrentYear", "NonConsolidated", "Duration"),
        ("net_income", 100.0, "CurrentYear", "連結", "期間"),
        ("shareholders_equity", 1000.0), ("net_assets", 2000.0), ("interest_bearing_debt", 500.0),
        ("cash_and_deposits", 300.0), ("operating_income", 120.0), ("income_tax", 30.0), ("pretax_income", 100.0),
        ("operating_cash_flow", 90.0), ("capital_expenditure", -40.0), ("treasury_stock_purchase_cash_flow", -50.0),
    ])
    assert got == pytest.approx({
        "roe": 0.1, "roic_pre_tax_proxy": 0.1, "roic": 0.07, "fcf_conversion": 0.5, "net_debt": 200.0,
        "buyback_cash_outflow": 50.0, "buyback_to_equity": 0.05,
    })


def test_nothing_is_inferred(spark):
    assert ratios(spark, [("net_income", 100.0), ("operating_cash_flow", 5.0)]) == {}


def test_components_and_gates(spark):
    got = ratios(spark, [
        ("debt_bonds", 10.0), ("debt_lease_current", 5.0), ("cash_and_deposits", 20.0), ("net_assets", -100.0),
        ("operating_income", 7.0), ("income_tax", 30.0), ("pretax_income", 20.0), ("net_income", 10.0),
        ("treasury_stock_purchase_cash_flow", 3.0),
    ])
    assert got == pytest.approx({
        "interest_bearing_debt_components_proxy": 15.0, "net_debt_components_proxy": -5.0, "roe": -0.1,
        "roic_pre_tax_proxy": 7.0 / -105.0, "buyback_cash_outflow": 3.0,
    })


def test_period_type_and_input_order(spark):
    got = ratios(spark, [
        ("net_income", 1.0, "0", "x", "instant"), ("net_income", 2.0, "0", "x", "duration"),
        ("net_income", 3.0, "0", "x", "duration"), ("net_assets", 10.0, "0", None, "時点"), ("net_assets", 20.0, "0", None, None),
    ])
    assert got == pytest.approx({"roe": 0.2})


def test_document_without_stamp_emits_nothing(spark):
    frame = filing(spark, [("net_income", 1.0), ("net_assets", 2.0)]).withColumn("known_at", F.lit(" "))
    assert financial.financial_features(frame).count() == 0


def test_largest_ownership_move(spark):
    schema = "doc_id string, issuer_stock_code string, filing_date string, known_at string, observed_at string, holder_name string, holding_ratio double, previous_holding_ratio double, holding_ratio_change double, n int"
    rows = [
        ("A", "7203", None, *STAMPS, "x", 0.10, 0.05, None, 0), ("A", "7203", None, *STAMPS, "y", 0.01, 0.09, -0.08, 1),
        ("A", "7203", None, *STAMPS, "z", 0.02, 0.10, 0.08, 2), ("B", "9999", "2024-01-01", *STAMPS, "w", 0.1, None, None, 0),
        ("C", " ", "2024-01-01", *STAMPS, "v", 0.1, 0.2, None, 0), ("D", "1111", "2024-01-02", *STAMPS, "u", 0.3, 0.2, float("nan"), 0),
    ]
    got = {r.source_doc_id: r for r in ownership.ownership_features(spark.createDataFrame(rows, schema), ["n"]).collect()}
    assert set(got) == {"A", "D"}
    assert (got["A"].value, got["A"].holder_name, got["A"].date) == (-0.08, "y", "2024-05-10")
    assert got["D"].value == pytest.approx(0.1)


def bars(spark, n=300, **columns):
    import pandas as pd

    days = pd.bdate_range("2022-01-03", periods=n)
    frame = pd.DataFrame({
        "Date": days.strftime("%Y-%m-%d"), "Code": "72030", "C": [100.0 + i for i in range(n)], "Va": 1e6,
        "known_at": days.strftime("%Y-%m-%dT06:00:00Z"),
        "observed_at": (days + pd.Timedelta(days=84)).strftime("%Y-%m-%dT06:00:00Z"),
    })
    return spark.createDataFrame(frame.assign(**columns))


def test_market_features(spark):
    got = market.market_features(bars(spark))
    momentum = got.where("feature = 'momentum_12_1'").orderBy("date").collect()
    assert len(momentum) == 300 - 252
    assert momentum[0].value == pytest.approx((100 + 231) / 100 - 1)
    day = market.prepare_bars(bars(spark)).orderBy("date").collect()[231]
    assert (momentum[0].known_at, momentum[0].observed_at, momentum[0].ticker) == (day.known_at, day.observed_at, "7203")
    assert got.where("feature = 'amihud_20d'").count() == 300 - 20
    assert got.where("feature = 'avg_trading_value_20d'").count() == 300 - 19
    quality.validate_features(got)


def test_adjusted_price_first_and_gaps(spark):
    frame = bars(spark, 30, AdjC=[None, 0.0] + [5.0] * 28)
    prices = [r.price for r in market.prepare_bars(frame).orderBy("date").collect()]
    assert prices[:3] == [100.0, None, 5.0]
    assert market.prepare_bars(frame, "raw").orderBy("date").first().price == 100.0
    with pytest.raises(ValueError):
        market.prepare_bars(frame.drop("C"), "raw")


def test_forward_returns(spark):
    got = market.forward_returns(bars(spark, 30), horizons=[5]).orderBy("date").collect()
    assert len(got) == 25 and got[0].forward_return == pytest.approx(105 / 100 - 1)
    assert got[0].decision_known_at < got[0].outcome_known_at
    with pytest.raises(ValueError):
        market.forward_returns(bars(spark, 5), horizons=[0])


SUMMARY = "Code string, DiscDate string, DiscNo string, CurFYEn string, known_at string, observed_at string, FSales double, FOP double, FOdP double, FNP double, FEPS double"


def disclosed(spark, rows):
    full = [
        ("72030", day, no, fy, f"{day}T06:00:00Z", f"{day}T07:00:00Z", *(list(values) + [None] * (5 - len(values))))
        for day, no, fy, values in rows
    ]
    return spark.createDataFrame(full, SUMMARY)


ROWS = [
    ("2024-05-10", "1", "2025-03-31", [100.0, 10.0]),
    ("2024-08-10", "2", "2025-03-31", [110.0, None]),
    ("2024-11-10", "3", "2025-03-31", [99.0, 15.0]),
    ("2024-11-11", "4", "2026-03-31", [500.0, 0.0]),
    ("2024-12-11", "5", "2026-03-31", [500.0, 5.0]),
]


def values_of(features):
    return sorted((r.date, r.feature, round(r.value, 6)) for r in features.collect())


def test_revisions(spark):
    assert values_of(forecast.forecast_revisions(disclosed(spark, ROWS))) == sorted([
        ("2024-08-10", "forecast_sales_revision_pct", 0.1), ("2024-08-10", "forecast_revision_breadth", 1.0),
        ("2024-11-10", "forecast_sales_revision_pct", -0.1), ("2024-11-10", "forecast_operating_profit_revision_pct", 0.5),
        ("2024-11-10", "forecast_revision_breadth", 0.0), ("2024-12-11", "forecast_sales_revision_pct", 0.0),
        ("2024-12-11", "forecast_revision_breadth", 0.5),
    ])


def test_state_in_steps_equals_one_batch(spark):
    whole, end = forecast.forecast_revisions_with_state(disclosed(spark, ROWS))
    first, state = forecast.forecast_revisions_with_state(disclosed(spark, ROWS[:2]))
    second, later = forecast.forecast_revisions_with_state(disclosed(spark, ROWS[1:]), state)
    assert values_of(whole) == values_of(first.unionByName(second))
    assert sorted(map(tuple, end.collect())) == sorted(map(tuple, later.collect()))
    again, same = forecast.forecast_revisions_with_state(disclosed(spark, ROWS), later)
    assert again.count() == 0 and sorted(map(tuple, same.collect())) == sorted(map(tuple, later.collect()))


def test_equal_stamps_differ_between_batch_and_state(spark):
    rows = [ROWS[0], ("2024-08-10", "2", "2025-03-31", [110.0]), ("2024-08-10", "3", "2025-03-31", [120.0])]
    assert forecast.forecast_revisions(disclosed(spark, rows)).where("source_disc_no = '3'").count() == 2
    stateful, state = forecast.forecast_revisions_with_state(disclosed(spark, rows))
    assert stateful.where("source_disc_no = '3'").count() == 0
    assert state.first().FSales == 110.0


def test_latest_asof_blocks_the_future(spark):
    schema = "date string, ticker string, feature string, value double, known_at string, observed_at string"
    rows = [
        ("2024-03-31", "7203", "roe", 0.1, "2024-05-10T06:00:00Z", "2024-05-10T06:00:00Z"),
        ("2024-03-31", "7203", "roe", 0.2, "2024-08-10T06:00:00Z", "2024-08-10T06:00:00Z"),
        ("2024-03-31", None, "roe", 0.3, "2024-01-10T06:00:00Z", "2024-08-10T06:00:00Z"),
    ]
    frame = spark.createDataFrame(rows, schema)
    assert [r.value for r in pit.latest_asof(frame, "2024-06-01").collect()] == [0.1]
    before = pit.latest_asof(frame.limit(1), "2024-06-01").collect()
    assert before == pit.latest_asof(frame, "2024-06-01").collect()
    with pytest.raises(ValueError):
        pit.latest_asof(frame.unionByName(frame), "2024-06-01")
    with pytest.raises(Exception, match="unusable availability stamps"):
        pit.filter_asof(frame.withColumn("known_at", F.lit("soon")), "2024-06-01").collect()
    with pytest.raises(ValueError):
        pit.filter_asof(frame, "2024-06-01", "absent")


def test_latest_asof_works_its_rows_out_once(spark):
    schema = "date string, ticker string, feature string, value double, known_at string, observed_at string"
    stamp = "2024-05-10T06:00:00Z"
    rows = spark.createDataFrame([("2024-03-31", t, "roe", v, stamp, stamp) for t in "ab" for v in (0.1, 0.2)], schema)
    features = rows.groupBy("date", "ticker", "feature", "known_at", "observed_at").agg(F.max("value").alias("value"))
    latest = pit.latest_asof(features, "2024-06-01")
    assert sorted((r.ticker, r.value) for r in latest.collect()) == [("a", 0.2), ("b", 0.2)]
    assert "Aggregate" not in latest._jdf.queryExecution().optimizedPlan().toString()
