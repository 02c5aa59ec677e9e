"""Features and labels from daily bars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.numbers import number, without_nan
from tidemark.functions.text import security_code
from tidemark.functions.times import to_utc
from tidemark.operators.ordered import calendar_bucket, over_neighbours
from tidemark.operators.quality import require_columns

FEATURES = ("momentum_12_1", "amihud_20d", "avg_trading_value_20d")
_KEYS = ["ticker"]
_ORDER = ["date", "known_at", "observed_at", "price", "trading_value"]


def _positive(value: Column) -> Column:
    return F.when(value > 0, value)


def prepare_bars(bars: DataFrame, price_policy: str = "adjusted") -> DataFrame:
    """Typed bars ``ticker, date, price, trading_value, known_at, observed_at``.

    ``adjusted`` takes the adjusted close and falls back to the close; ``raw``
    takes the close only, for studies where restated prices would leak.
    """
    require_columns(bars, ["Date", "Code", "known_at", "observed_at", "Va"], "daily-bar")
    candidates = {"adjusted": ["AdjC", "C"], "raw": ["C"]}[price_policy]
    present = [c for c in candidates if c in bars.columns]
    if not present:
        raise ValueError(f"daily bars need one of {candidates}")
    typed = bars.select(
        security_code(F.col("Code")).alias("ticker"),
        F.col("Date").try_cast("date").alias("date"),
        _positive(F.coalesce(*[number(F.col(c)) for c in present])).alias("price"),
        _positive(number(F.col("Va"))).alias("trading_value"),
        to_utc(F.col("known_at")).alias("known_at"),
        to_utc(F.col("observed_at")).alias("observed_at"),
    )
    dated = typed.dropna(subset=["ticker", "date", "known_at", "observed_at"])
    # Nothing is filled here: the columns only become ones that cannot be null.
    never = {"ticker": F.lit(""), "date": F.lit("1970-01-01").cast("date")}
    return dated.withColumns({name: F.coalesce(F.col(name), value) for name, value in never.items()})


def _check_lags(lookback: int, skip: int) -> None:
    if lookback <= skip:
        raise ValueError("momentum lookback must exceed the skipped rows")


def _check_horizons(horizons: Sequence[int]) -> list[int]:
    horizons = [int(h) for h in horizons]
    if not horizons or min(horizons) <= 0:
        raise ValueError("forward-return horizons must be positive")
    return horizons


def _momentum(window: WindowSpec, lookback: int, skip: int) -> dict[str, Column]:
    change = F.lag("price", skip).over(window) / F.lag("price", lookback).over(window) - 1
    return {
        "momentum": without_nan(change),
        "momentum_known": F.lag("known_at", skip).over(window),
        "momentum_observed": F.lag("observed_at", skip).over(window),
    }


def _ahead(window: WindowSpec, horizons: Sequence[int]) -> dict[str, Column]:
    """Per horizon one struct of the realised return and its availability."""
    return {
        f"ahead_{h}": F.struct(
            F.lit(h).alias("horizon_trading_days"),
            without_nan(F.lead("price", h).over(window) / F.col("price") - 1).alias("forward_return"),
            F.lead("known_at", h).over(window).alias("outcome_known_at"),
            F.lead("observed_at", h).over(window).alias("outcome_observed_at"),
        )
        for h in horizons
    }


def momentum_with_returns(
    bars: DataFrame,
    *,
    horizons: Sequence[int] = (21, 63),
    lookback: int = 252,
    skip: int = 21,
    price_policy: str = "adjusted",
) -> DataFrame:
    """Momentum of each bar beside its realised returns, from one pass over the bars.

    ``date, ticker, value, known_at, observed_at, decision_known_at`` and ``ahead``: a label struct per horizon
    whose outcome is there.  Rows without momentum are left out, rows without an outcome are not.
    """
    _check_lags(lookback, skip)
    horizons = _check_horizons(horizons)
    wide = over_neighbours(
        prepare_bars(bars, price_policy), _KEYS, _ORDER, calendar_bucket(F.col("date")),
        [lambda w: _momentum(w, lookback, skip) | _ahead(w, horizons)], before=lookback, after=max(horizons),
    )
    return wide.where(F.col("momentum").isNotNull()).select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "ticker",
        F.col("momentum").alias("value"),
        F.col("momentum_known").alias("known_at"),
        F.col("momentum_observed").alias("observed_at"),
        F.col("known_at").alias("decision_known_at"),
        F.filter(
            F.array(*[f"ahead_{h}" for h in horizons]),
            lambda a: a["forward_return"].isNotNull() & a["outcome_known_at"].isNotNull(),
        ).alias("ahead"),
    )


def market_features(
    bars: DataFrame,
    *,
    lookback: int = 252,
    skip: int = 21,
    liquidity_window: int = 20,
    price_policy: str = "adjusted",
    features: Sequence[str] = FEATURES,
) -> DataFrame:
    """Momentum, illiquidity and mean trading value in the common feature form.

    Momentum is known when its newest price was; all columns share one sort.
    ``features`` limits the work to some of them.
    """
    unknown = set(features) - set(FEATURES)
    if unknown or not features:
        raise ValueError(f"unknown market features: {sorted(unknown)}")
    _check_lags(lookback, skip)
    if liquidity_window < 2:
        raise ValueError("liquidity window needs at least two rows")

    def lags(window):
        return {"previous_price": F.lag("price", 1).over(window), **_momentum(window, lookback, skip)}

    def illiquidity(_):
        change = F.col("price") / F.col("previous_price") - 1
        return {"illiquidity": without_nan(F.abs(change) / F.col("trading_value"))}

    def rolling(window):
        frame = window.rowsBetween(1 - liquidity_window, 0)

        def full_mean(name):
            return F.when(F.count(name).over(frame) == liquidity_window, F.avg(name).over(frame))

        return {
            "amihud": full_mean("illiquidity"),
            "mean_value": full_mean("trading_value"),
            "window_observed": F.max("observed_at").over(frame),
        }

    liquid = [f for f in features if f != "momentum_12_1"]
    stages = [lags, illiquidity, rolling] if liquid else [lags]
    reach = max(lookback, liquidity_window)
    wide = over_neighbours(
        prepare_bars(bars, price_policy), _KEYS, _ORDER, calendar_bucket(F.col("date")), stages, before=reach, after=0
    )
    sources = {
        "momentum_12_1": ("momentum", "momentum_known", "momentum_observed"),
        "amihud_20d": ("amihud", "known_at", "window_observed"),
        "avg_trading_value_20d": ("mean_value", "known_at", "window_observed"),
    }
    cells = F.array(
        *[
            F.struct(
                F.lit(name).alias("feature"),
                F.col(value).alias("value"),
                F.col(known).alias("known_at"),
                F.col(observed).alias("observed_at"),
            )
            for name, (value, known, observed) in sources.items()
            if name in features
        ]
    )
    long = wide.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "ticker", F.inline(cells))
    return long.where(F.col("value").isNotNull())


def forward_returns(
    bars: DataFrame,
    *,
    horizons: Sequence[int] = (21, 63),
    price_policy: str = "adjusted",
) -> DataFrame:
    """Realised returns ``h`` rows ahead with decision and outcome availability.  Labels only."""
    horizons = _check_horizons(horizons)
    wide = over_neighbours(
        prepare_bars(bars, price_policy), _KEYS, _ORDER, calendar_bucket(F.col("date")), [lambda w: _ahead(w, horizons)],
        before=0, after=max(horizons),
    )
    long = wide.select(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        "ticker",
        F.col("known_at").alias("decision_known_at"),
        F.inline(F.array(*[f"ahead_{h}" for h in horizons])),
    )
    return long.where(F.col("forward_return").isNotNull() & F.col("outcome_known_at").isNotNull()).select(
        "date", "ticker", "horizon_trading_days", "forward_return",
        "decision_known_at", "outcome_known_at", "outcome_observed_at",
    )
