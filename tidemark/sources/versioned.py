"""Keyed tables in buckets whose new content becomes visible by one small manifest.

A commit writes the touched buckets to a folder of its own, then a manifest that names the folder of every bucket.  Readers
follow the newest manifest, so a job that is lost at any step leaves the old content as it was, and buckets that a commit
does not touch are neither read nor written.  One writer at a time; the manifest lists buckets, never rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.sources.datasets import remove_path

BUCKET = "bucket"


@dataclass(frozen=True)
class Head:
    """Newest commit: its number, the folder number of every bucket with rows, and what the writer noted."""

    commit: int
    folders: dict[int, int]
    buckets: int
    note: str


class VersionedTable:
    """``schema`` is that of the rows, without the bucket; ``buckets`` counts for a new table and is kept with it."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: Sequence[str], buckets: int = 64) -> None:
        self.spark, self.root, self.key = spark, root.rstrip("/"), tuple(key)
        self.schema = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
        self._buckets = buckets

    def _fs(self, path: str):
        target = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _commits(self) -> list[int]:
        fs, folder = self._fs(f"{self.root}/commits")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def head(self) -> Head | None:
        """The newest commit; none for a table that does not exist yet."""
        commits = self._commits()
        return self._manifest(commits[-1]) if commits else None

    def _manifest(self, commit: int) -> Head:
        fs, path = self._fs(f"{self.root}/commits/{commit:012d}")
        stream = fs.open(path)
        try:
            body = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Head(commit, {int(b): c for b, c in body["folders"].items()}, body["buckets"], body["note"])

    def bucket(self) -> Column:
        """Bucket of a row, from its key alone."""
        head = self.head()
        return F.pmod(F.xxhash64(*self.key), F.lit(head.buckets if head else self._buckets)).cast("int")

    def read(self, only: Iterable[int] | None = None) -> DataFrame:
        """Rows of the newest commit, of the given buckets or of all."""
        head = self.head()
        chosen = {} if head is None else head.folders
        if only is not None:
            wanted = set(only)
            chosen = {b: c for b, c in chosen.items() if b in wanted}
        paths = [f"{self.root}/data/commit={c}/{BUCKET}={b}" for b, c in sorted(chosen.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return found.select(*self.schema.names)

    def stage(self, rows: DataFrame) -> int:
        """Write the whole content of the buckets in ``rows`` (which has a bucket column); not visible before ``publish``."""
        head = self.head()
        commit = head.commit + 1 if head else 0
        writer = rows.select(*self.schema.names).write.mode("overwrite").option("compression", "zstd")
        writer.partitionBy(BUCKET).parquet(f"{self.root}/data/commit={commit}")
        return commit

    def _staged(self, commit: int) -> list[int]:
        """Buckets that the staged commit has rows of."""
        fs, folder = self._fs(f"{self.root}/data/commit={commit}")
        names = [f.getPath().getName().partition("=") for f in fs.listStatus(folder)]
        return sorted(int(value) for name, _, value in names if name == BUCKET)

    def publish(self, commit: int, touched: Iterable[int], note: str = "") -> None:
        """Make staged buckets visible: the manifest is written aside and takes its name in one step."""
        head = self.head()
        if commit != (head.commit + 1 if head else 0):
            raise RuntimeError(f"commit {commit} of {self.root} does not follow its newest one; is there a second writer?")
        folders = {**(head.folders if head else {}), **dict.fromkeys(touched, commit)}
        body = {"folders": {str(b): c for b, c in sorted(folders.items())}, "buckets": head.buckets if head else self._buckets, "note": note}
        fs, aside = self._fs(f"{self.root}/commits/.{uuid.uuid4().hex}")
        stream = fs.create(aside)
        try:
            stream.write(bytearray(json.dumps(body).encode()))
        finally:
            stream.close()
        _, final = self._fs(f"{self.root}/commits/{commit:012d}")
        if fs.exists(final) or not fs.rename(aside, final):
            raise RuntimeError(f"commit {commit} of {self.root} exists already")

    def replace_documents(self, rows: DataFrame, document: str = "doc_id", note: str = "") -> None:
        """Rows of the documents in ``rows`` take the place of their earlier ones; all other documents stay.

        The table's key is the document.  Only the touched buckets are read and written; a rerun gives the same table.
        """
        if self.key != (document,):
            raise ValueError(f"the key of {self.root} is not {document}")
        placed = rows.withColumn(BUCKET, self.bucket())
        if self.head() is None:  # nothing to replace: the rows are read once, and what was written tells the buckets
            commit = self.stage(placed.hint("rebalance", BUCKET))
            self.publish(commit, self._staged(commit), note)
            return
        touched = sorted(r[0] for r in placed.select(BUCKET).distinct().collect())  # no more than there are buckets
        kept = self.read(touched).join(placed.select(BUCKET, document).distinct(), [BUCKET, document], "left_anti")
        merged = kept.select(*self.schema.names).unionByName(placed.select(*self.schema.names))
        self.publish(self.stage(merged.hint("rebalance", BUCKET)), touched, note)

    def vacuum(self, keep: int = 2) -> None:
        """Remove what none of the ``keep`` newest commits refers to, and older manifests."""
        commits = self._commits()
        kept = [self._manifest(c) for c in commits[-keep:]]
        used = {(c, b) for head in kept for b, c in head.folders.items()}
        for commit in commits[:-keep]:
            remove_path(self.spark, f"{self.root}/commits/{commit:012d}")
        fs, data = self._fs(f"{self.root}/data")
        newest = commits[-1] if commits else -1
        for folder in fs.listStatus(data) if fs.exists(data) else []:
            number = int(folder.getPath().getName().partition("=")[2])
            if number > newest:
                continue  # staged and not published yet
            for bucket in fs.listStatus(folder.getPath()):
                name, _, value = bucket.getPath().getName().partition("=")
                if name == BUCKET and (number, int(value)) not in used:
                    remove_path(self.spark, bucket.getPath().toString())
