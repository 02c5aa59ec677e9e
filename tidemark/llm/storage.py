"""Intermediate tables in the cluster's shared folder, and small Arrow helpers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, ensure_checkpoint_dir

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the session settings and send this package to the workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="tidemark-")) / f"{root.name}.zip"  # the driver serves it
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return configure(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet and read back: the lineage ends there and lost executors cost nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the named columns; any other column stays behind."""
    chosen: list[Column] = [
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ]
    return docs.select(*chosen, *(F.col(c) for c in columns))


def fold(column: str, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of about ``limit`` bytes of a text column; one long text may exceed it."""
    for batch in batches:
        start, size, lengths = 0, 0, pa.compute.binary_length(batch.column(column)).to_pylist()
        for i, n in enumerate(lengths):
            size += (n or 0) + 32
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
