"""Management-forecast revisions between disclosures of one fiscal year."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.numbers import finite
from tidemark.functions.text import clean, disclosure_ticker
from tidemark.functions.times import to_utc
from tidemark.operators.ordered import calendar_bucket, first_of_group, last_before
from tidemark.operators.quality import require_columns

METRICS = tuple(v.FORECAST_FEATURES)
KEY = ["ticker", "cur_fy_end"]
STATE_COLUMNS = [*KEY, *METRICS, "last_known_at", "last_disc_no"]
# (known, observed) as disclosed; the rest only makes the order total.
_ORDER = ["known_at", "observed_at", "disc_no", "disc_date", *METRICS]


def disclosures(summary: DataFrame) -> DataFrame:
    """Typed disclosures; rows without ticker, fiscal year, date or stamps are dropped."""
    require_columns(
        summary, ["Code", "DiscDate", "CurFYEn", "known_at", "observed_at", *METRICS], "financial-summary"
    )
    disc_no = F.col("DiscNo") if "DiscNo" in summary.columns else F.lit(None).cast("string")
    typed = summary.select(
        disclosure_ticker(F.col("Code")).alias("ticker"),
        clean(F.col("CurFYEn")).alias("cur_fy_end"),
        clean(F.col("DiscDate")).alias("disc_date"),
        clean(disc_no).alias("disc_no"),
        to_utc(F.col("known_at")).alias("known_at"),
        to_utc(F.col("observed_at")).alias("observed_at"),
        *[finite(F.col(m)).alias(m) for m in METRICS],
    )
    return typed.dropna(subset=[*KEY, "disc_date", "known_at", "observed_at"])


PREVIOUS = {m: f"__previous_{m}" for m in METRICS}


def _with_previous(rows: DataFrame, order: list[Column], bucket: Column) -> DataFrame:
    """Add the last explicit forecast of each metric and whether any disclosure came before."""
    earlier = {PREVIOUS[m]: F.col(m) for m in METRICS}
    return last_before(rows, KEY, order, bucket, {**earlier, "__seen": F.lit(True)})


def emit_revisions(rows: DataFrame) -> DataFrame:
    """Features of disclosures that carry the forecasts before them (``PREVIOUS``, ``__seen``)."""

    def both(m):
        return F.col(m).isNotNull() & F.col(PREVIOUS[m]).isNotNull()

    def revision(m):
        base = F.col(PREVIOUS[m])
        return F.try_divide(F.col(m) - base, F.abs(base))

    signs = [F.when(both(m), F.signum(F.col(m) - F.col(PREVIOUS[m]))).otherwise(0.0) for m in METRICS]
    compared = [F.when(both(m), 1).otherwise(0) for m in METRICS]
    values = {name: revision(m) for m, name in v.FORECAST_FEATURES.items()}
    values[v.BREADTH_FEATURE] = F.try_divide(reduce(add, signs), reduce(add, compared))
    cells = [F.struct(F.lit(name).alias("feature"), value.alias("value")) for name, value in values.items()]
    long = rows.where(F.col("__seen")).select(
        F.col("disc_date").alias("date"),
        "ticker",
        F.inline(F.array(*cells)),
        "known_at",
        "observed_at",
        F.col("cur_fy_end").alias("source_fiscal_year_end"),
        F.col("disc_no").alias("source_disc_no"),
    )
    return long.where(F.col("value").isNotNull())


def forecast_revisions(summary: DataFrame) -> DataFrame:
    """Revision of each metric against its last explicit forecast, and their mean sign."""
    order = [F.col(c).asc() for c in _ORDER]
    return emit_revisions(_with_previous(disclosures(summary), order, calendar_bucket(F.col("known_at"))))


def advancing(rows: DataFrame, state: DataFrame | None) -> DataFrame:
    """Rows that move their key forward: one per availability stamp, later than the state."""
    once = first_of_group(rows, [*KEY, "known_at"], [F.col(c).asc() for c in _ORDER[1:]])
    if state is None:
        return once
    reached = state.select(*KEY, F.col("last_known_at").alias("__reached"))
    newer = F.col("__reached").isNull() | (F.col("known_at") > F.col("__reached"))
    return once.join(reached, KEY, "left").where(newer).drop("__reached")


def forecast_revisions_with_state(
    summary: DataFrame, state: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Incremental form: (features of the new disclosures, updated state).

    The state holds, per (ticker, fiscal year end), the last explicit forecasts
    and the stamp reached.  Replayed or older disclosures change nothing.
    """
    fresh = disclosures(summary)
    rows = advancing(fresh, state).withColumn("__carried", F.lit(False))
    if state is not None:
        carried = state.select(
            *KEY,
            F.lit(None).cast("string").alias("disc_date"),
            F.col("last_disc_no").alias("disc_no"),
            F.col("last_known_at").alias("known_at"),
            F.col("last_known_at").alias("observed_at"),
            *METRICS,
            F.lit(True).alias("__carried"),
        )
        rows = rows.unionByName(carried)
    order = [F.col("__carried").desc(), F.col("known_at").asc_nulls_first()]
    bucket = F.when(F.col("__carried"), F.lit(-(1 << 31))).otherwise(calendar_bucket(F.col("known_at")))
    features = emit_revisions(_with_previous(rows, order, bucket).where(~F.col("__carried")))

    position = F.struct((~F.col("__carried")).alias("fresh"), F.col("known_at"))
    latest = [F.max_by(m, F.when(F.col(m).isNotNull(), position)).alias(m) for m in METRICS]
    updated = rows.groupBy(*KEY).agg(
        *latest, F.max("known_at").alias("last_known_at"), F.max_by("disc_no", position).alias("last_disc_no")
    )
    return features, updated.select(*STATE_COLUMNS)
