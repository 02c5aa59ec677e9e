"""Exact deduplication against a persistent index of text digests.

The index is a table bucketed and sorted by digest: one row per distinct text
with the row that stays.  New data is first reduced to one candidate per digest
(combined before the shuffle, so a text with very many copies is a few rows),
then joined to the index with a sort-merge anti-join that reads the index
without a shuffle or sort, and appended in the same layout.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import documents, materialize

DIGEST_SCHEMA = "digest binary, keep_id long, keep_chars int, group_size long"
_WHITE = " \t\n\x0b\x0c\r"
# (characters, id) as one decimal: fixed width, so the maximum is a hash aggregate combined map-side.
_SHIFT = "18446744073709551616BD"
_TOP = "9223372036854775807BD"


def text_digest(column: str) -> Column:
    """SHA-256 of a text without ``[\\x20\\x09-\\x0D]``; null counts as empty."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.translate(text, _WHITE, "").cast("binary"), 256))


def digests(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc_id, digest, chars`` and the named columns, one row per document."""
    return documents(docs, *columns).select(
        "doc_id",
        text_digest("text").alias("digest"),
        F.length("text").alias("chars"),
        *columns,
    )


def _candidates(rows: DataFrame) -> DataFrame:
    """One row per digest: most characters, then smallest id, and the number of rows."""
    rank = F.expr(f"cast(chars * {_SHIFT} + ({_TOP} - doc_id) as decimal(38, 0))")
    best = rows.select("digest", rank.alias("rank")).groupBy("digest").agg(
        F.max("rank").alias("best"), F.count("*").alias("group_size")
    )
    return best.select(
        "digest",
        F.expr(f"cast({_TOP} - best % {_SHIFT} as long)").alias("keep_id"),
        F.expr(f"cast(best div {_SHIFT} as int)").alias("keep_chars"),
        "group_size",
    )


class DigestIndex:
    """A bucketed, sorted table of digests at a path that outlives the session.

    Opening the same path with the same number of buckets continues the index.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} ({DIGEST_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, rows: DataFrame) -> None:
        """Append the digests that are not in the index yet, each with the best of the new rows.

        What is known stays as it is: its text has been kept before.
        """
        candidates = _candidates(rows)
        fresh = candidates.join(self.table().hint("merge"), "digest", "left_anti")
        fresh = materialize(fresh, "fresh-digests")
        (
            fresh.select("digest", "keep_id", "keep_chars", "group_size")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .option("path", self.path)
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )
        self.spark.catalog.refreshTable(self.name)

    def lookup(self, rows: DataFrame) -> DataFrame:
        """Rows with the index entry of their digest.

        The files are read without their bucketing here: both sides are shuffled, so
        adaptive execution can split the rows of a text with very many copies.
        """
        entries = self.spark.read.schema(self.table().schema).parquet(self.path)
        return rows.join(entries, "digest", "left")


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Decide for every row of ``docs``; new texts are added to the index.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256`` for each row, dropped ones too.  Texts are
    equal when they are so without ``[\\x20\\x09-\\x0D]``; the row with the most code points in its original
    text stays, then the smallest id.  Null text is empty, and empty texts are equal.  Rows repeated under one id
    count in ``group_size`` and share the decision.  Rows without an id rank last: they stay only if
    no row with an id has the same text.  Other columns are ignored; an empty table gives no rows.
    Texts the index held before are kept nowhere in ``docs`` unless ``docs`` has the row that was kept.
    """
    rows = materialize(digests(docs), "digests")
    index.add(rows)
    return index.lookup(rows).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, in all their columns; of rows repeated under one id and text one stays."""
    kept = deduplicate(docs, index).where("kept").select(
        F.col("doc_id").alias("kept_id"), F.unhex("text_sha256").alias("kept_digest")
    )
    # The join and the choice of one row use the same plain columns, so the texts are shuffled once.
    tail = uuid.uuid4().hex
    names = [f"{name}_{tail}" for name in ("id", "none", "digest", "number")]
    id_, none, digest, number = names
    marked = docs.withColumns(
        {
            id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            none: F.col("doc_id").isNull(),
            digest: text_digest("text"),
        }
    )
    keys = kept.select(
        F.coalesce("kept_id", F.lit(0)).alias(id_), F.col("kept_id").isNull().alias(none), F.col("kept_digest").alias(digest)
    )
    stay = marked.join(keys, names[:3], "left_semi")
    first = F.row_number().over(Window.partitionBy(*names[:3]).orderBy(F.lit(0)))
    return stay.withColumn(number, first).where(F.col(number) == 1).drop(*names)
