"""Partitioned Parquet datasets, landed payload files and run manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.text import content_hash


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever Hadoop file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote; a missing one is no error."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def finished_folders(spark: SparkSession, path: str, started: bool = False) -> list[str]:
    """Names of the folders below a path whose write has committed; with ``started``, of all of them."""
    if not path_exists(spark, path):
        return []
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(target) if f.isDirectory()]
    return [n for n in names if started or path_exists(spark, f"{path}/{n}/_SUCCESS")]


def read_dataset(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """A partitioned dataset; partition columns come from the paths.

    Without a schema, files are unioned by column name, which reads every
    footer; give the schema for large datasets.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(root)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed text payloads, one per file: ``path, payload, payload_sha256``."""
    files = spark.read.option("wholetext", "true").text(path)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("payload"),
        content_hash(F.col("value")).alias("payload_sha256"),
    )


def source_listing(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """Files under a path: ``source_key, source_etag, source_size`` and ``path, length``.

    The contents are not read.  Modification time stands in for the etag.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    return files.select(
        F.col("path").alias("source_key"),
        F.unix_micros("modificationTime").cast("string").alias("source_etag"),
        F.col("length").alias("source_size"),
        "path",
        "length",
    )


def write_dataset(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), *, mode: str = "overwrite"
) -> None:
    """Write Parquet (zstd).  ``overwrite`` replaces only the partitions present in ``df``.

    ``append`` is for change logs, where earlier rows are never rewritten.
    """
    writer = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(root)


def document_manifest(metrics: DataFrame, documents: DataFrame, error: Column | None = None) -> DataFrame:
    """Per document: status, rows and the distinct metrics found.

    ``documents`` lists every document worked on, so one without rows is
    recorded as ``no_matches`` and not picked up again.
    """
    found = metrics.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_set("metric")).alias("metrics")
    )
    joined = documents.join(found, "doc_id", "left")
    failed = F.lit(None).cast("string") if error is None else error
    status = F.when(failed.isNotNull(), "error").when(F.col("rows").isNull(), "no_matches").otherwise("ok")
    return joined.withColumns(
        {
            "status": status,
            "rows": F.coalesce("rows", F.lit(0)),
            "metrics": F.coalesce("metrics", F.array().cast("array<string>")),
        }
    )


def run_manifest(manifest: DataFrame) -> DataFrame:
    """One row per run: documents by status and rows written."""
    status = F.col("status")
    return manifest.agg(
        F.count_if(status == "ok").alias("processed_documents"),
        F.count_if(status == "no_matches").alias("no_match_documents"),
        F.count_if(status == "error").alias("failed_documents"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_written"),
    )
