"""Groups are cut into segments and chunks; rows must be those of one plain window."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import cross_section as xs
from tidemark.operators import market, ordered
from tidemark.operators.ordered import calendar_bucket, last_before, over_neighbours, score_bucket, sequence
from tidemark.plans import adapters

SF = "/root/testdata/sf0.001"


def by_time():
    return F.floor(F.col("t") / 7).cast("int")


@pytest.fixture
def skewed(spark):
    rng = random.Random(7)
    keys = ["hot"] * 300 + [rng.choice(["a", "b", "c", None]) for _ in range(120)]
    rows = [(k, rng.randrange(60), i, rng.choice([None, float(i)])) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, "k string, t int, id int, v double").repartition(5)


def rows(df):
    return sorted(df.collect(), key=str)


def test_sequence(skewed):
    whole = Window.partitionBy("k")
    plain = skewed.withColumn("n", F.row_number().over(whole.orderBy("t", "id")).cast("long")).withColumn("m", F.count("*").over(whole))
    assert rows(sequence(skewed, ["k"], ["t", "id"], by_time(), seq="n", size="m")) == rows(plain)


def test_weighted_sequence(skewed):
    counted = skewed.groupBy("k", "t").agg(F.count("*").alias("w"))
    plain = counted.withColumn("n", F.sum("w").over(Window.partitionBy("k").orderBy("t")))
    assert rows(sequence(counted, ["k"], ["t"], by_time(), seq="n", weight=F.col("w"))) == rows(plain)


def test_scores_and_nulls(spark):
    values = [None, float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1e-310, -1e-310, 1e-5, 0.5, 0.51, 1.0, 1.5, -1.5, -2.0, 1e300, -1e300]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 2)], "id int, v double")
    plain = df.withColumn("n", F.row_number().over(Window.orderBy("v", "id")).cast("long"))
    assert str(rows(sequence(df, [], ["v", "id"], score_bucket(F.col("v")), seq="n"))) == str(rows(plain))


def test_buckets_never_fall(spark):
    rng = random.Random(1)
    values = sorted(rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 12) for _ in range(3000))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    found = [r.b for r in df.orderBy("i").select(score_bucket(F.col("v")).alias("b")).collect()]
    assert found == sorted(found) and len(set(found)) > 500
    days = spark.sql("SELECT explode(array(NULL, date'1890-01-01', date'1969-12-31', date'1970-01-01', date'2024-05-05')) d")
    found = [r.b for r in days.select(calendar_bucket(F.col("d")).alias("b")).collect()]
    assert found == sorted(found) and len(set(found)) == 5


@pytest.mark.parametrize("chunk", [1, 16, 4096])
def test_neighbours(skewed, monkeypatch, chunk):
    monkeypatch.setattr(ordered, "CHUNK_ROWS", chunk)
    stages = [
        lambda w: {"back": F.lag("id", 7).over(w), "ahead": F.lead("id", 3).over(w)},
        lambda w: {"mean": F.sum("t").over(w.rowsBetween(-6, 2)), "prior": F.lag("back", 4).over(w)},
    ]
    plain = skewed
    for stage in stages:
        plain = plain.withColumns(stage(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(over_neighbours(skewed, ["k"], ["t", "id"], by_time(), stages, before=11, after=3)) == rows(plain)


def test_last_before(skewed):
    columns = {"p": F.col("v"), "seen": F.lit(True)}
    found = rows(last_before(skewed, ["k"], ["t", "id"], by_time(), columns))
    assert len(found) == 420
    for key in ("hot", "a", None):
        last, first = None, True
        for row in sorted((r for r in found if r.k == key), key=lambda r: (r.t, r.id)):
            assert row.p == last and row.seen == (None if first else True)
            last, first = (row.v if row.v is not None else last), False


def test_plans_start_no_job(spark):
    """Building the plan of an ordered operator runs nothing; all of them follow the same plan at any size."""
    bars, panel = adapters.bars(spark, SF), adapters.panel(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        market.market_features(bars)
        market.momentum_with_returns(bars)
        xs.quantile_summary(xs.assign_quantiles(panel))
        assert list(tracker.getJobIdsForGroup("plans")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_momentum_with_returns_equals_the_join(spark):
    bars = adapters.bars(spark, SF)
    joined = xs.attach_labels(
        market.market_features(bars, features=["momentum_12_1"], lookback=20, skip=3), market.forward_returns(bars, horizons=[2, 5])
    )
    beside = xs.known_pairs(
        market.momentum_with_returns(bars, horizons=[2, 5], lookback=20, skip=3).select("*", F.inline("ahead"))
    )
    columns = ["ticker", "date", "value", "horizon_trading_days", "forward_return", "known_at", "outcome_known_at"]
    assert rows(beside.select(columns)) == rows(joined.select(columns)) != []


def test_infinite_prices_give_no_nan(spark):
    days = [(f"2024-01-{d:02d}", "1234", 1.0 if d % 3 else float("inf"), 5.0) for d in range(1, 29)]
    df = spark.createDataFrame([(*r, f"{r[0]}T00:00:00Z", f"{r[0]}T00:00:00Z") for r in days], "Date string, Code string, C double, Va double, known_at string, observed_at string")
    found = market.market_features(df, lookback=6, skip=3, liquidity_window=2).collect()
    assert found and not any(r.value != r.value for r in found)
    assert not any(r.forward_return != r.forward_return for r in market.forward_returns(df, horizons=[3]).collect())


def test_median_of_ties(spark):
    values = [1.0] * 500 + [2.0] * 499 + [None, float("nan")]
    df = spark.createDataFrame([("d", 1, v) for v in values] + [("d", 2, v) for v in (1.0, 4.0)], "date string, quantile int, forward_return double")
    found = {r.quantile: (r["count"], r.median_return) for r in xs.quantile_summary(df).collect()}
    assert found == {1: (999, 1.0), 2: (2, 2.5)}


@pytest.mark.parametrize("kind", ["string", "long", "date"])
def test_quantiles_of_a_date_of_ties_and_nulls(spark, kind):
    """Half of a date without a score and most of the rest with one score: ranks are plain, and no cell holds much of it."""
    n = 4000
    score = F.when(F.col("id") % 2 == 0, None).when(F.col("id") % 40 == 1, F.rand(3)).otherwise(1.5)
    ticker = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int") * 3) if kind == "date" else F.col("id").cast(kind)
    data = spark.range(n).select(F.lit("d").alias("date"), ticker.alias("ticker"), score.alias("factor"), F.lit(1).alias("x")).persist()
    ranks = Window.partitionBy("date", F.col("factor").isNull()).orderBy("factor", "ticker")
    plain = {r.ticker: r.n for r in data.withColumn("n", F.row_number().over(ranks)).where("factor IS NOT NULL").collect()}
    got = xs.assign_quantiles(data, n_quantiles=10)
    rows_ = got.collect()
    assert len(rows_) == n and all((r["quantile"] is None) == (r.factor is None) for r in rows_)
    by_rank = sorted((plain[r.ticker], r["quantile"]) for r in rows_ if r.factor is not None)
    assert [q for _, q in by_rank] == sorted(q for _, q in by_rank) and [sum(q == k for _, q in by_rank) for k in range(1, 11)] == [200] * 10
    cells = data.where("factor IS NOT NULL").groupBy("factor", ordered.prefix_bucket(data, "ticker")).count().agg(F.max("count")).first()[0]
    assert cells < n / (8 if kind == "string" else 4)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_rows_are_not_shuffled_again_for_their_segment(spark):
    bars = spark.range(100).select(
        F.col("id").cast("string").alias("k"), F.coalesce(F.col("id"), F.lit(0)).alias("t"), F.current_date().alias("day")
    ).withColumn("k", F.coalesce("k", F.lit("")))
    numbered = sequence(bars, ["k"], ["t"], calendar_bucket(F.col("day")))
    # One of the rows, two of the summary and one that brings the summary to the rows.
    assert len(shuffles(numbered)) <= 4
    assert not any("isnull(" in line for line in shuffles(numbered))
