"""Aggregate expressions for "first in input order" semantics.

They combine on the map side, so a group of any size reaches the shuffle as
one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.text import clean


def ranking(columns: Sequence[str | Column], *last: Column) -> Column:
    """Sort key made of the order columns and trailing tie-breakers."""
    members = [F.col(c) if isinstance(c, str) else c for c in columns] + list(last)
    return F.struct(*[m.alias(f"k{i}") for i, m in enumerate(members)])


def earliest(value: Column, order: Sequence[str | Column]) -> Column:
    """Mergeable form of "first non-null value": the smallest (order, value) pair.

    Reduce pairs further with ``min`` and read the result's field ``value``.
    """
    pair = F.struct(ranking(order).alias("rank") if order else F.lit(0).alias("rank"), value.alias("value"))
    return F.min(F.when(value.isNotNull(), pair))


def present(df: DataFrame, name: str) -> Column:
    """A column with blank text as null; null throughout when the frame lacks it."""
    if name not in df.columns:
        return F.lit(None).cast("string")
    return clean(F.col(name)) if isinstance(df.schema[name].dataType, StringType) else F.col(name)


def first_present(df: DataFrame, name: str, order: Sequence[str | Column]) -> Column:
    """The first value of a column in ``order`` that is neither null nor blank text."""
    return earliest(present(df, name), order)["value"].alias(name)


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order of the rows, so that equal groups have equal sums.

    Three or more values are added as decimals where these hold them all; values beyond 18 places or 1e19 are added as doubles.
    """
    digits = value.try_cast("decimal(38,18)")
    held = F.count_if(value.isNotNull() & ~digits.cast("double").eqNullSafe(value)) == 0
    exact = F.when((F.count(value) > 2) & held, F.try_sum(digits).cast("double"))
    return F.coalesce(exact, F.sum(value))


def exact_mean(value: Column) -> Column:
    """Mean of doubles by ``exact_sum``; null for a group without a value."""
    return F.try_divide(exact_sum(value), F.count(value))
