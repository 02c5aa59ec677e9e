"""Order-dependent work inside groups of any size, by one plan for every size.

A plain window function sorts each whole group in one task, which is wrong for
a group that holds a third of the data.  Here a group is cut into segments by a
*bucket*: a value computed from the row alone that never falls in the order
of the group (a calendar period, a step of a score).  Rows are numbered or looked
back at inside their segment; one summary row per (group, bucket), combined before
the shuffle, carries counts and last values across segments.  Lags and rolling
frames work on chunks of fixed length with copies of the neighbouring rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampType

_BUCKET, _LOCAL, _BEFORE = "__bucket", "__local", "__before"
_SEQ, _CHUNK, _HOME = "__seq", "__chunk", "__home"

#: Rows per chunk of a group, unless the neighbourhood needs more.
CHUNK_ROWS = 4096
_NULLS_FIRST = -(1 << 31)

Stage = Callable[[WindowSpec], dict[str, Column]]
# Sort columns; a bare name means ascending.
Order = Sequence[str | Column]


def calendar_bucket(moment: Column, days: int = 366) -> Column:
    """Number of the period of ``days`` that a date or timestamp falls in; null comes first."""
    day = F.datediff(moment.cast("date"), F.lit("1970-01-01").cast("date"))
    return F.coalesce(F.floor(day / days).cast("int"), F.lit(_NULLS_FIRST))


def score_bucket(score: Column, steps: int = 32) -> Column:
    """Number of the step of a score, ``steps`` to each doubling of its size, in ascending order; null comes first.

    Null is below minus infinity, NaN above infinity, as Spark sorts them.
    """
    size = F.abs(score)
    step = F.greatest(F.floor(F.log2(F.greatest(size, F.lit(1e-300))) * steps) + 1100 * steps, F.lit(0)).cast("int")
    signed = (
        F.when(F.isnan(score), F.lit(1 << 30))
        .when(size == float("inf"), F.signum(score).cast("int") * (1 << 29))
        .when(score > 0, step)
        .when(score < 0, -step)
        .otherwise(F.lit(0))
    )
    return F.when(score.isNull(), F.lit(_NULLS_FIRST)).otherwise(signed)


def prefix_bucket(df: DataFrame, name: str, length: int = 2) -> Column:
    """A bucket that never falls along a column: the start of a text, a step of a number, a period of a date."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, StringType):
        return F.substring(column, 1, length)
    if isinstance(kind, NumericType):
        return score_bucket(column.cast("double"))
    return calendar_bucket(column) if isinstance(kind, (DateType, TimestampType)) else F.lit(0)


def _segment_window(keys: Sequence[str], order: Order) -> WindowSpec:
    return Window.partitionBy(*keys, _BUCKET).orderBy(*order)


def _earlier_segments(keys: Sequence[str]) -> WindowSpec:
    """Over one row per (group, bucket): as many rows as the order has buckets."""
    return Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)


def _attach(rows: DataFrame, summary: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Bring per-(group, bucket) columns to the rows; the keys of one side are unique.

    Keys that are never null are compared plainly: a null-safe comparison hides that the rows lie together by these keys
    already, and they would be shuffled and sorted once more.
    """
    names = [*keys, _BUCKET]
    renamed = summary.select(*[F.col(k).alias(f"__key_{k}") for k in names], *columns)
    match = reduce(lambda a, b: a & b, [same(rows, k, F.col(f"__key_{k}")) for k in names])
    return rows.join(renamed, match, "left").select(*rows.columns, *columns)


def same(df: DataFrame, name: str, other: Column) -> Column:
    """Whether a column equals another one of its values; null equals null where the column may be null."""
    return F.col(name).eqNullSafe(other) if df.schema[name].nullable else F.col(name) == other


def sequence(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    bucket: Column,
    *,
    seq: str = _SEQ,
    size: str | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """Number the rows of each group 1..n in ``order``; optionally add n as ``size``.

    ``order`` must be total for a repeatable result, and ``bucket`` must not fall along it.  With ``weight`` a row
    counts as that many rows and gets the number of its last one.
    """
    rows = df.withColumn(_BUCKET, bucket)
    one = F.lit(1) if weight is None else weight
    summary = rows.groupBy(*keys, _BUCKET).agg(F.sum(one).alias(_LOCAL))
    summary = summary.withColumn(_BEFORE, F.coalesce(F.sum(_LOCAL).over(_earlier_segments(keys)), F.lit(0)))
    carried = [_BEFORE]
    if size is not None:
        summary = summary.withColumn(size, F.sum(_LOCAL).over(Window.partitionBy(*keys)))
        carried.append(size)
    window = _segment_window(keys, order)
    if weight is None:
        number = F.row_number().over(window)
    else:
        number = F.sum(weight).over(window.rowsBetween(Window.unboundedPreceding, 0))
    local = rows.withColumn(seq, number.cast("long"))
    out = _attach(local, summary.drop(_LOCAL), keys, carried)
    return out.withColumn(seq, F.col(seq) + F.col(_BEFORE)).drop(_BEFORE, _BUCKET)


def over_neighbours(
    df: DataFrame, keys: Sequence[str], order: Order, bucket: Column, stages: Sequence[Stage], *, before: int, after: int
) -> DataFrame:
    """Window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``stages`` are functions from a window to new columns; a later stage may use
    the columns of an earlier one.  Groups are cut into chunks of fixed length, and each
    chunk gets copies of the neighbouring rows it must see.
    """
    span = max(CHUNK_ROWS, 4 * (before + after), 1)
    position = (F.col(_SEQ) - 1) % span
    home = F.floor((F.col(_SEQ) - 1) / span)
    no_chunk = F.lit(None).cast("long")
    seen_by = F.array_compact(
        F.array(
            home,
            F.when(position >= span - before, home + 1).otherwise(no_chunk),
            F.when((position < after) & (home > 0), home - 1).otherwise(no_chunk),
        )
    )
    numbered = sequence(df, keys, order, bucket)
    out = numbered.withColumn(_HOME, home).withColumn(_CHUNK, F.explode(seen_by))
    window = Window.partitionBy(*keys, _CHUNK).orderBy(_SEQ)
    for stage in stages:
        out = out.withColumns(stage(window))
    return out.where(F.col(_CHUNK) == F.col(_HOME)).drop(_SEQ, _CHUNK, _HOME)


def last_before(
    df: DataFrame, keys: Sequence[str], order: Order, bucket: Column, columns: dict[str, Column]
) -> DataFrame:
    """For each new column, the last non-null value strictly before the row in its group."""
    window = _segment_window(keys, order)
    carried = {name: f"__carried_{name}" for name in columns}
    sources = {name: f"__source_{name}" for name in columns}
    rows = df.withColumn(_BUCKET, bucket).withColumns({sources[name]: c for name, c in columns.items()})
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns(
        {n: F.last(F.col(sources[n]), ignorenulls=True).over(earlier) for n in columns}
        | {carried[n]: F.last(F.col(sources[n]), ignorenulls=True).over(whole) for n in columns}
        | {_LOCAL: F.row_number().over(window)}
    )
    ends = local.where(F.col(_LOCAL) == 1).select(*keys, _BUCKET, *carried.values())
    ends = ends.withColumns(
        {c: F.last(F.col(c), ignorenulls=True).over(_earlier_segments(keys)) for c in carried.values()}
    )
    out = _attach(local.drop(*carried.values()), ends, keys, list(carried.values()))
    out = out.withColumns({n: F.coalesce(F.col(n), F.col(carried[n])) for n in columns})
    return out.drop(*carried.values(), *sources.values(), _LOCAL, _BUCKET)


def first_of_group(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """One row per group, the first in ``order``; null keys form a group.

    Spark limits each map task to its own first row per group before the
    shuffle, so the size of a group does not reach any single task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_SEQ, F.row_number().over(window)).where(F.col(_SEQ) == 1).drop(_SEQ)


def top_of_group(df: DataFrame, keys: Sequence[str], order: Order, k: int, rank: str) -> DataFrame:
    """The first ``k`` rows per group with their rank; limited per map task as above."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)
