"""Snapshot comparison: append-only logs of new and revised records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import number
from tidemark.functions.text import content_hash
from tidemark.functions.times import jst_text, to_utc
from tidemark.operators.ordered import first_of_group

FILING_KEY = ("seq_number", "doc_id")
SERIES_KEY = ("source_id", "dataset", "db", "series_id", "period_code")
_VALUE_PLACES = 12


def _compare(
    current: DataFrame,
    previous: DataFrame | None,
    key: Sequence[str],
    compared: Mapping[str, Column],
    newest: Sequence[Column],
) -> DataFrame:
    """Current rows that are absent from, or differ from, the version before.

    ``current`` may hold several versions of a key, told apart by ``observed_at``: each is compared with the one before it,
    the first with the previous snapshot.  Each previous key is used once, so rows are never multiplied; nulls match
    nulls.  Records that vanished are not reported.
    """
    seen = Window.partitionBy(*key).orderBy(to_utc(F.col("observed_at")).asc_nulls_first(), *[c.asc() for c in compared.values()])
    inside = {f"__before_{name}": F.lag(expr).over(seen) for name, expr in compared.items()}
    rows = current.withColumns({"__nth": F.row_number().over(seen), **inside})
    later = F.col("__nth") > 1
    if previous is None:
        found, old = later, {name: F.col(f"__before_{name}") for name in compared}
    else:
        snapshot = first_of_group(previous, key, newest).select(
            *[F.col(k).alias(f"__key_{k}") for k in key],
            *[expr.alias(f"__old_{name}") for name, expr in compared.items()],
            F.lit(True).alias("__found"),
        )
        matches = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in key])
        rows = rows.join(snapshot, matches, "left")
        found = later | F.col("__found").isNotNull()
        old = {name: F.when(later, F.col(f"__before_{name}")).otherwise(F.col(f"__old_{name}")) for name in compared}
    same = reduce(lambda a, b: a & b, [expr.eqNullSafe(old[name]) for name, expr in compared.items()])
    change = F.when(~found, "new").when(~same, "revised")
    return rows.withColumn("change_type", change).where(F.col("change_type").isNotNull()).select(*current.columns, "change_type")


def filing_changes(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """New and revised document-list records, by record hash.

    A revision becomes known at the provider's operation time when that parses,
    otherwise when it was observed.
    """
    changed = _compare(
        current,
        previous,
        FILING_KEY,
        {"record_sha256": F.col("record_sha256")},
        [to_utc(F.col("observed_at")).desc_nulls_last(), F.col("record_sha256").desc()],
    )
    revised_known = F.coalesce(jst_text(F.col("operation_datetime")), to_utc(F.col("observed_at")))
    known = F.when(F.col("change_type") == "revised", revised_known).otherwise(to_utc(F.col("known_at")))
    return changed.withColumn("known_at", known)


def series_compared() -> dict[str, Column]:
    """What makes two observations of a series differ: the value to 12 places and the provider's update day."""
    return {"value": F.round(number(F.col("value")), _VALUE_PLACES), "source_last_update": F.col("source_last_update").cast("string")}


def series_changes(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """New and revised macro observations, by value (12 places) and provider update day."""
    return _compare(
        current,
        previous,
        SERIES_KEY,
        series_compared(),
        [to_utc(F.col("observed_at")).desc_nulls_last(), F.col("value").desc()],
    )


def record_hash(fields: Sequence[str], prefix: str = "", numeric: Sequence[str] = ()) -> Column:
    """Hash of the fields as compact JSON with sorted keys; missing values are written as null, ``numeric`` ones as numbers."""
    members = [
        (F.col(f"{prefix}{name}").cast("bigint") if name in numeric else F.col(f"{prefix}{name}")).alias(name)
        for name in sorted(fields)
    ]
    return content_hash(F.to_json(F.struct(*members), {"ignoreNullFields": "false"}))


def changed_payloads(
    payloads: DataFrame, kept: DataFrame, key: str = "manifest_id", newest: str | None = None
) -> DataFrame:
    """Raw payloads whose hash differs from the one last kept for their key.

    ``newest`` names the column of ``kept`` that tells its versions apart; without it each key has one row.  A payload that
    returns to an older version differs from the last one and is kept again.
    """
    hashed = payloads.withColumn("sha256", content_hash(F.col("payload")))
    last = kept if newest is None else first_of_group(kept, [key], [F.col(newest).desc_nulls_last(), F.col("sha256").desc()])
    return hashed.join(last.select(key, "sha256").distinct(), [key, "sha256"], "left_anti")
