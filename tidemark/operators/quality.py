"""Input checks: required columns, violation counts and strict mode."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import to_utc

FEATURE_COLUMNS = ("date", "ticker", "feature", "value", "known_at", "observed_at")
VERSION_KEY = ("date", "ticker", "feature", "known_at", "observed_at")


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    """Raise if a column is missing.  Looks at the schema only; runs no job."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing {what} columns: {missing}")


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row: for each named condition, the number of rows that violate it."""
    return df.agg(*[F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in checks.items()])


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row, one column ``duplicates``: rows beyond the first of each key."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def reject_if_any(counts: DataFrame, what: str) -> None:
    """Strict mode: run the counts and raise if one is not zero."""
    found = {name: n for name, n in counts.first().asDict().items() if n}
    if found:
        raise ValueError(f"{what}: {found}")


def refused(checks: Mapping[str, Column], what: str, otherwise: Column) -> Column:
    """Strict mode in passing: ``otherwise``, or a failure of the job that meets a row which violates a check.

    A condition of this kind is never moved into a scan, so no violating row is skipped.
    """
    failed = F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()])
    return F.when(failed.isNotNull(), F.raise_error(F.concat(F.lit(f"{what}: "), failed)).cast("boolean")).otherwise(otherwise)


def feature_violations(df: DataFrame) -> DataFrame:
    """One row: unparsable availability stamps and repeated feature versions."""
    require_columns(df, FEATURE_COLUMNS, "feature")
    versions = df.groupBy(*VERSION_KEY).agg(F.count(F.lit(1)).alias("n"))
    return versions.agg(
        F.coalesce(F.sum(F.when(to_utc(F.col("known_at")).isNull(), F.col("n"))), F.lit(0)).alias("bad_known_at"),
        F.coalesce(F.sum(F.when(to_utc(F.col("observed_at")).isNull(), F.col("n"))), F.lit(0)).alias(
            "bad_observed_at"
        ),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_versions"),
    )


def validate_features(df: DataFrame) -> None:
    """Raise unless every row has both stamps and each feature version is unique."""
    reject_if_any(feature_violations(df), "feature rows violate the contract")
