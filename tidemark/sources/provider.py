"""Market-data frames stamped with lineage and availability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from tidemark import vocabulary as v
from tidemark.functions.times import end_of_jst_day, known_from_disclosure, to_utc

_DISCLOSURES = "financial_summary"
_MIDNIGHT = "00:00:00"


def _moment_text(name: str, kind) -> Column:
    """A date or timestamp as text; midnight stamps keep only their date, fractions of a second stay."""
    if isinstance(kind, DateType):
        return F.date_format(name, "yyyy-MM-dd").alias(name)
    whole_day = (F.date_format(name, "HH:mm:ss") == _MIDNIGHT) & (F.date_format(name, "SSSSSS") == "000000")
    fraction = F.when(F.date_format(name, "SSSSSS") != "000000", F.concat(F.lit("."), F.date_format(name, "SSSSSS")))
    return (
        F.when(whole_day, F.date_format(name, "yyyy-MM-dd"))
        .otherwise(F.concat(F.date_format(name, "yyyy-MM-dd HH:mm:ss"), F.coalesce(fraction, F.lit(""))))
        .alias(name)
    )


def stamp(frame: DataFrame, dataset: str, target_day: str | Column, observed_at: Column) -> DataFrame:
    """Provider columns unchanged (moments as text) plus source, dataset, target day and stamps.

    Disclosures become known at their own date and time, everything else at the
    end of the target day.
    """
    day = F.lit(target_day) if isinstance(target_day, str) else target_day
    moments = (DateType, TimestampType, TimestampNTZType)
    columns = [
        _moment_text(f.name, f.dataType) if isinstance(f.dataType, moments) else F.col(f.name)
        for f in frame.schema.fields
    ]
    if dataset == _DISCLOSURES:
        time = F.col("DiscTime") if "DiscTime" in frame.columns else F.lit(None).cast("string")
        known = known_from_disclosure(F.col("DiscDate"), time, day)
    else:
        known = end_of_jst_day(day)
    return frame.select(
        *columns,
        F.lit(v.SOURCE_MARKET).alias("source_id"),
        F.lit(dataset).alias("dataset"),
        day.alias("retrieval_target_date"),
        to_utc(observed_at).alias("observed_at"),
        known.alias("known_at"),
    )
