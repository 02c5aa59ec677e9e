"""Macro time-series payloads with parallel date and value arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocabulary as v
from tidemark.functions.text import blank_to_null, parsed_once
from tidemark.functions.times import known_from_update, to_utc, update_day
from tidemark.operators.normalize import split_rejects

RESPONSE_SCHEMA = """
    STATUS STRING, NEXTPOSITION STRING,
    RESULTSET ARRAY<STRUCT<
        SERIES_CODE: STRING, NAME_OF_TIME_SERIES: STRING, UNIT: STRING, FREQUENCY: STRING,
        CATEGORY: STRING, LAST_UPDATE: STRING,
        VALUES: STRUCT<SURVEY_DATES: ARRAY<STRING>, `VALUES`: ARRAY<STRING>>>>
"""


def series_value(text: Column) -> Column:
    """A printed observation; the provider's missing marks and bad numbers become null."""
    parsed = F.when(~text.isin(*v.MISSING_SERIES_VALUES), text.try_cast("double"))
    return F.when(~F.isnan(parsed), parsed)


def _failures() -> dict[str, Column]:
    """Conditions on a parsed response under which none of its series is read."""
    status, following = F.col("__body.STATUS"), F.coalesce(F.col("__body.NEXTPOSITION"), F.lit(""))
    return {
        "unreadable payload": status.isNull() & F.col("__body.RESULTSET").isNull(),
        "status is not 200": F.coalesce(status.try_cast("int"), F.lit(0)) != 200,
        "more pages follow": ~following.isin("", "0"),
    }


def series_rejects(payloads: DataFrame) -> DataFrame:
    """Responses that give no series, with ``error``: unreadable, failed, or one page of several."""
    parsed = parsed_once(payloads, "__body", "payload", RESPONSE_SCHEMA)
    return split_rejects(parsed, _failures())[1].drop("__body")


def series_items(payloads: DataFrame) -> DataFrame:
    """One row per returned series.  ``payloads`` has ``dataset, db, payload`` and any lineage columns.

    Responses listed by ``series_rejects`` give none.
    """
    parsed, _ = split_rejects(parsed_once(payloads, "__body", "payload", RESPONSE_SCHEMA), _failures())
    # The outer form keeps Spark from testing the parsed array before exploding it, a second parse.
    exploded = parsed.withColumn("item", F.explode_outer("__body.RESULTSET")).drop("payload", "__body")
    exploded = exploded.where(F.col("item").isNotNull())
    dates = F.coalesce(F.col("item.VALUES.SURVEY_DATES"), F.array().cast("array<string>"))
    values = F.coalesce(F.col("item.VALUES.VALUES"), F.array().cast("array<string>"))
    return exploded.withColumns({"survey_dates": dates, "survey_values": values})


def read_series(items: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(observations, rejected series): one row per period; unequal arrays reject their series.

    ``items`` comes from ``series_items`` or has the same columns, with
    ``observed_at, source_url, payload_sha256`` as lineage.
    """
    valid, rejects = split_rejects(
        items, {"dates and values differ in length": F.size("survey_dates") != F.size("survey_values")}
    )
    periods = valid.select(
        "*", F.inline(F.arrays_zip(F.col("survey_dates").alias("period_code"), F.col("survey_values").alias("printed")))
    )
    observed = to_utc(F.col("observed_at"))
    last_update = blank_to_null(F.col("item.LAST_UPDATE"))
    observations = periods.select(
        F.lit(v.SOURCE_SERIES).alias("source_id"),
        "dataset",
        "db",
        F.coalesce("item.SERIES_CODE", F.lit("")).alias("series_id"),
        F.col("item.NAME_OF_TIME_SERIES").alias("series_name"),
        "period_code",
        series_value(F.col("printed")).alias("value"),
        F.col("item.FREQUENCY").alias("frequency"),
        F.col("item.UNIT").alias("unit"),
        F.col("item.CATEGORY").alias("category"),
        F.date_format(update_day(last_update), "yyyy-MM-dd").alias("source_last_update"),
        F.coalesce(known_from_update(last_update), observed).alias("known_at"),
        observed.alias("observed_at"),
        "source_url",
        "payload_sha256",
        F.lit(run_id).alias("ingestion_run_id"),
    )
    return observations, rejects
