"""Point-in-time reconstruction: what was knowable at a decision time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import to_utc, utc_literal
from tidemark.operators.ordered import first_of_group
from tidemark.operators.quality import refused, require_columns, validate_features
from tidemark.session import scratch_path
from tidemark.sources.datasets import write_dataset

Moment = str | date | datetime

FACT_KEY = ("stock_code", "metric", "context_id", "relative_year", "consolidation")


def _known_by(moment: Moment, known_at: str) -> Column:
    return to_utc(F.col(known_at)) <= utc_literal(moment)


def filter_asof(df: DataFrame, decision_time: Moment, known_at: str = "known_at", *, strict: bool = True) -> DataFrame:
    """Rows known by the decision time.

    With ``strict`` the job that reads an unusable stamp fails; without it such rows are merely invisible.  Either way
    the input is read once.
    """
    require_columns(df, [known_at], "availability")
    visible = _known_by(decision_time, known_at)
    if strict:
        visible = refused({known_at: to_utc(F.col(known_at)).isNull()}, "unusable availability stamps", visible)
    return df.where(visible)


def latest_asof(
    df: DataFrame,
    decision_time: Moment,
    logical_key: Sequence[str] = ("ticker", "feature"),
    *,
    strict: bool = True,
) -> DataFrame:
    """The newest version of each logical key known by the decision time.

    Newest is by (known, observed, date).  Rows with a null key are left out.  With ``strict`` the rows are stored once
    for the check and the answer, so what they are worked out from is read and shuffled once.
    """
    require_columns(df, logical_key, "logical key")
    if strict:
        stored = scratch_path(df.sparkSession, "features")
        write_dataset(df, stored)
        df = df.sparkSession.read.schema(df.schema).parquet(stored)
        validate_features(df)
    visible = filter_asof(df, decision_time, strict=False).dropna(subset=list(logical_key))
    newest = [to_utc(F.col(c)).desc() for c in ("known_at", "observed_at")] + [F.col("date").desc()]
    return first_of_group(visible, logical_key, newest)


def latest_fact(df: DataFrame, decision_time: Moment, key: Sequence[str] = FACT_KEY) -> DataFrame:
    """The newest statement fact per key known by the decision time; null keys count as values."""
    newest = [to_utc(F.col(c)).desc() for c in ("known_at", "observed_at")] + [F.col("doc_id").desc()]
    return first_of_group(filter_asof(df, decision_time, strict=False), key, newest)


def known_changes(df: DataFrame, decision_time: Moment, change: str = "holding_ratio_change") -> DataFrame:
    """Rows with a reported change that were known by the decision time."""
    return filter_asof(df, decision_time, strict=False).where(F.col(change).isNotNull())


def rebuild_state(change_logs: Sequence[DataFrame], decision_time: Moment, record_key: Sequence[str]) -> DataFrame:
    """State at the decision time: per record, its latest known version in the change logs."""
    log = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), change_logs)
    newest = [to_utc(F.col(c)).desc() for c in ("known_at", "observed_at")]
    return first_of_group(filter_asof(log, decision_time, strict=False), record_key, newest)
