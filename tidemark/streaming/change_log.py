"""Streams of changed records over a keyed history.

Each micro-batch holds lists or responses as a provider gave them, each with its ``observed_at``.  What was observed of a key
is kept in order of observation, in buckets of the key, and a batch rewrites only the buckets that its keys fall into.
Changes are marked along that order.  So a list that arrives late is put where it belongs: it neither replaces what was
observed after it nor shows up as a step back, and the log is the same whatever order the lists came in.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.times import jst_text, to_utc
from tidemark.operators.changes import FILING_KEY, SERIES_KEY, series_compared
from tidemark.sources.versioned import BUCKET, VersionedTable

RUN = "ingestion_run_id"
CHANGE = "change_type"
_SHARE = "__share"
#: Shares of a bucket, each sorted and written by one task.
SHARES = 4


def _filing_known() -> Column:
    """A revision becomes known at the provider's operation time, otherwise when it was observed."""
    revised = F.coalesce(jst_text(F.col("operation_datetime")), to_utc(F.col("observed_at")))
    return F.when(F.col(CHANGE) == "revised", revised).otherwise(to_utc(F.col("known_at")))


@dataclass(frozen=True)
class Feed:
    """Key of a record, what makes two observations differ, and when a change becomes known."""

    key: tuple[str, ...]
    compared: Callable[[], dict[str, Column]]
    known_at: Callable[[], Column]


# Lists are complete per file date, so a record counts per date.
FILINGS = Feed(("file_date", *FILING_KEY), lambda: {"record_sha256": F.col("record_sha256")}, _filing_known)
SERIES = Feed(SERIES_KEY, series_compared, lambda: to_utc(F.col("known_at")))


class ChangeLog:
    """History of a feed below ``root``; ``schema`` is that of the incoming rows."""

    def __init__(self, spark: SparkSession, root: str, feed: Feed, schema: StructType, buckets: int = 64) -> None:
        self.feed = feed
        self._columns = [n for n in schema.names if n != RUN]
        kept = [f for f in schema.fields if f.name != RUN]
        stored = StructType([*kept, StructField(RUN, StringType()), StructField(CHANGE, StringType())])
        self.table = VersionedTable(spark, root, stored, feed.key, buckets)

    def merge(self, batch: DataFrame, run_id: str, note: str = "") -> None:
        """Add observations; one seen before changes nothing, and what is new carries ``run_id``."""
        fresh = batch.select(*self._columns, F.lit(run_id).alias(RUN), self.table.bucket().alias(BUCKET))
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # no more than there are buckets
        before = self.table.read(touched).drop(CHANGE)
        rows = before.withColumn("__new", F.lit(0)).unionByName(fresh.withColumn("__new", F.lit(1)))
        self.table.publish(self.table.stage(self._marked(rows)), touched, note)

    def _marked(self, rows: DataFrame) -> DataFrame:
        """Each observation once, with the change it makes against the one before it."""
        compared = {f"__{name}": expr for name, expr in self.feed.compared().items()}
        # A bucket lies in a few tasks from here to its files; dealt by the whole key, every task would write to every bucket.
        share = F.pmod(F.shiftright(F.xxhash64(*self.feed.key), 16), F.lit(SHARES))
        rows = rows.withColumns({**compared, "__seen": to_utc(F.col("observed_at")), _SHARE: share}).repartition(BUCKET, _SHARE)
        version = ["__seen", *compared]
        order = Window.partitionBy(BUCKET, _SHARE, *self.feed.key).orderBy(*[F.col(c).asc_nulls_first() for c in (*version, "__new")])
        there = F.lag(F.lit(True)).over(order)

        def same(names: list[str]) -> Column:
            equal = F.coalesce(there, F.lit(False))
            for name in names:
                equal = equal & F.col(name).eqNullSafe(F.lag(name).over(order))
            return equal

        once = rows.withColumn("__again", same(version)).where(~F.col("__again"))
        change = F.when(there.isNull(), "new").when(~same(list(compared)), "revised")
        return once.withColumn(CHANGE, change)

    def changes(self) -> DataFrame:
        """The log: new and revised records in the shape of the incoming rows, with run and kind of change."""
        rows = self.table.read().where(F.col(CHANGE).isNotNull()).drop(BUCKET)
        return rows.withColumn("known_at", self.feed.known_at())

    def snapshot(self) -> DataFrame:
        """The last observation of every key."""
        last = Window.partitionBy(BUCKET, *self.feed.key).orderBy(
            to_utc(F.col("observed_at")).desc_nulls_last(), *[e.desc() for e in self.feed.compared().values()]
        )
        return self.table.read().withColumn("__nth", F.row_number().over(last)).where("__nth = 1").drop("__nth", BUCKET, CHANGE)


def start_change_log(stream: DataFrame, log: ChangeLog, checkpoint: str, run_id: str = "run") -> StreamingQuery:
    """Merge every micro-batch into the log; the note of the last commit tells a replayed batch from a new one."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        head = log.table.head()
        if head is None or not head.note or int(head.note) < batch_id:
            log.merge(batch, f"{run_id}-{batch_id}", str(batch_id))

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
