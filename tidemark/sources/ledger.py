"""Incremental normalisation: listing, pending sources, rows, manifests, index.

A run writes its rows, then its manifests, then its index entries, each to a folder of its own, and only the last step makes
the rows visible.  Rows count when the newest index entry of their source names their run.  So a run that is lost after its
rows leaves nothing behind that a reader sees, one that is lost after its manifests is finished by the next run, and a
source that is worked again replaces its earlier rows without touching them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.text import first_ten
from tidemark.functions.times import iso_z, to_utc
from tidemark.operators.select import outdated_sources, work_newest
from tidemark.sources.datasets import finished_folders, remove_path

INDEX_SCHEMA = (
    "source_key string, source_etag string, source_size long, status string, alias_config_version int, "
    "alias_config_sha256 string, run string"
)
_INDEXED = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
_COMPACT = "compact"
Process = Callable[[DataFrame], tuple[DataFrame, DataFrame]]


def submit_date(submitted: Column, known: Column) -> Column:
    """Folder of a document: its submission day, else the day it became known, else ``unknown``."""
    return first_ten(submitted, iso_z(to_utc(known)))


class Ledger:
    """Runs below ``root``; ``schema`` is that of the rows, with ``source_key``, ``metric`` and ``submit_date`` among them.

    Runs are numbered in order; one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, alias_version: int, alias_sha256: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._version, self._sha256 = alias_version, alias_sha256
        self._schema = StructType([*[f for f in schema.fields if f.name != "submit_date"],
                                   StructField("run", StringType()), StructField("submit_date", StringType())])

    def _path(self, kind: str, run: str = "") -> str:
        return f"{self.root}/{kind}/run={run}" if run else f"{self.root}/{kind}"

    def _runs(self, kind: str, *, started: bool = False) -> list[str]:
        """Runs whose folder of this kind is complete; with ``started``, also those that were lost while writing it."""
        return sorted(n.removeprefix("run=") for n in finished_folders(self.spark, self._path(kind), started))

    def _write(self, rows: DataFrame, kind: str, run: str, *partition: str) -> None:
        writer = rows.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*partition) if partition else writer).parquet(self._path(kind, run))

    def index(self) -> DataFrame:
        """The newest entry of every source."""
        paths = [self._path("index", run) for run in self._runs("index")]
        if not paths:
            return self.spark.createDataFrame([], INDEX_SCHEMA)
        newest = Window.partitionBy("source_key").orderBy(F.col("run").desc())
        entries = self.spark.read.schema(INDEX_SCHEMA).parquet(*paths)
        return entries.withColumn("__nth", F.row_number().over(newest)).where("__nth = 1").drop("__nth")

    def rows(self) -> DataFrame:
        """Rows of the run that last worked their source."""
        current = self.index().where(F.col("status") == "ok").select("source_key", "run")
        if not self._runs("data"):
            return self.spark.createDataFrame([], self._schema)
        stored = self.spark.read.schema(self._schema).parquet(self._path("data"))
        return stored.join(current, ["source_key", "run"], "left_semi").select(*self._schema.names)

    def manifests(self) -> DataFrame:
        """What every completed run noted per source."""
        return self.spark.read.parquet(*[self._path("manifests", run) for run in self._runs("manifests")])

    def run(self, sources: DataFrame, process: Process, run_id: str, limit: int | None = None) -> DataFrame:
        """Work off the newest ``limit`` sources that are new or changed, and return the run's own manifest.

        ``sources`` has ``source_key, source_etag, source_size``.  ``process`` turns chosen sources into rows and failures
        (``source_key, error``).  A failed source gets no index entry, so the next run takes it again.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
            raise ValueError("a run id is letters, digits, _ and -")
        self.recover()
        known = [r for kind in ("work", "data", "manifests", "index") for r in self._runs(kind, started=True)]
        run = f"{1 + max((int(r[:12]) for r in known), default=0):012d}.{run_id}"

        outdated = outdated_sources(sources, self.index(), alias_version=self._version, alias_sha256=self._sha256)
        self._write(work_newest(outdated, limit).select("source_key", "source_etag", "source_size"), "work", run)
        work = self.spark.read.parquet(self._path("work", run))
        rows, failures = process(work)
        # One task per day where days are small, several where one is large.
        by_day = rows.select(*[c for c in self._schema.names if c != "run"]).hint("rebalance", "submit_date")
        self._write(by_day, "data", run, "submit_date")
        self._write(self._documents(work, failures, run), "manifests", run)
        noted = self.spark.read.parquet(self._path("manifests", run))
        self._write(self._summary(sources, outdated, noted, run, limit), "runs", run)
        self._enter(noted, run)
        return self.spark.read.parquet(self._path("runs", run))

    def _documents(self, work: DataFrame, failures: DataFrame, run: str) -> DataFrame:
        written = self.spark.read.schema(self._schema).parquet(self._path("data", run))
        found = written.groupBy("source_key").agg(
            F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_set("metric")).alias("metrics"), F.min("submit_date").alias("submit_date")
        )
        failed = failures.groupBy("source_key").agg(F.min("error").alias("error"))
        status = F.when(F.col("error").isNotNull(), "error").when(F.col("rows").isNull(), "no_matches").otherwise("ok")
        folder = F.concat(F.lit(f"{self._path('data', run)}/submit_date="), F.col("submit_date"))
        return work.join(found, "source_key", "left").join(failed, "source_key", "left").select(
            "source_key", "source_etag", "source_size", status.alias("status"), "error",
            F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("metrics", F.array().cast("array<string>")).alias("metrics"),
            F.when(status == "ok", folder).alias("output_path"), F.lit(self._version).alias("alias_config_version"),
            F.lit(self._sha256).alias("alias_config_sha256"), F.lit(run).alias("run"),
        )

    def _summary(self, sources: DataFrame, outdated: DataFrame, noted: DataFrame, run: str, limit: int | None) -> DataFrame:
        status = F.col("status")
        worked = noted.agg(
            F.count_if(status == "ok").alias("processed_documents"), F.count_if(status == "no_matches").alias("no_match_documents"),
            F.count_if(status == "error").alias("failed_documents"),
            F.coalesce(F.sum(F.when(status == "ok", F.col("rows"))), F.lit(0)).alias("rows_written"), F.count(F.lit(1)).alias("__worked"),
        )
        listed, waiting = sources.count(), outdated.count()
        return worked.select(
            F.lit(run.partition(".")[2]).alias("run_id"), "processed_documents", F.lit(listed - waiting).cast("long").alias("skipped_documents"),
            "no_match_documents", "failed_documents", "rows_written", (F.lit(waiting) - F.col("__worked")).cast("long").alias("pending_documents"),
            F.lit(limit).cast("long").alias("max_documents_per_run"), F.lit(self._version).alias("alias_config_version"),
            F.lit(self._sha256).alias("alias_config_sha256"), F.current_timestamp().alias("observed_at"),
        )

    def _enter(self, noted: DataFrame, run: str) -> None:
        self._write(noted.where(F.col("status") != "error").select(*_INDEXED), "index", run)

    def recover(self) -> None:
        """Enter runs whose manifests are complete and which were lost before their index entries."""
        entered = self._runs("index")
        compacted = max((r[:12] for r in entered if r.endswith(f".{_COMPACT}")), default="")
        for run in self._runs("manifests"):
            if run not in entered and run[:12] > compacted:
                self._enter(self.spark.read.parquet(self._path("manifests", run)), run)

    def compact(self) -> None:
        """Replace the index folders by one; being lost in between only leaves entries twice."""
        self.recover()
        entered = self._runs("index")
        if len(entered) > 1:
            self._write(self.index(), "index", f"{entered[-1][:12]}.{_COMPACT}")
            for run in entered:
                if not (run.endswith(f".{_COMPACT}") and run[:12] == entered[-1][:12]):
                    remove_path(self.spark, self._path("index", run))

    def vacuum(self) -> None:
        """Remove rows that no source refers to any more, of lost runs too."""
        self.recover()
        used = {r[0] for r in self.index().where(F.col("status") == "ok").select("run").distinct().collect()}
        for run in self._runs("data", started=True):
            if run not in used:
                remove_path(self.spark, self._path("data", run))
                remove_path(self.spark, self._path("work", run))
