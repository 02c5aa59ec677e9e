"""Token ids as ORC: one row per document, in ascending document order.

ORC stores the ids with integer run-length encoding in stripes.  Row indexes
(minimum and maximum per stride) and Bloom filters on ``doc_id`` let a reader
skip stripes and strides; Spark reads stripes in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import documents, slices
from tidemark.llm.tokens import END_ID, encoder, vocabulary_path

STORE_SCHEMA = "doc_id long, shard int, shard_start long, n_tokens long, ids array<int>"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("shard", pa.int32()), ("shard_start", pa.int64()), ("n_tokens", pa.int64()),
     ("ids", pa.list_(pa.int32()))]
)


def write_tokens(
    docs: DataFrame,
    path: str,
    vocabulary: str | None = None,
    *,
    end_id: int = END_ID,
    stripe_bytes: int = 16 << 20,
    stride_rows: int = 1000,
    bloom_fpp: float = 0.01,
) -> None:
    """Encode ``doc_id, text`` and write ORC files whose names follow ascending ``doc_id``.

    Null text is empty (only the end id); null ids come first; repeated rows are kept, rows of one id
    in the order of a hash of their text.  Other columns are ignored.  An empty table gives an empty store.
    """
    source = vocabulary or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, start = encoder(source), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text"):
            ids, sizes = enc.encode(batch.column("text").to_pylist(), end_id)
            ends = np.concatenate(([0], np.cumsum(sizes)))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(sizes), shard, np.int32)),
                    pa.array(start + ends[:-1]),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                ],
                schema=_ARROW,
            )
            start += int(ends[-1])

    # The hash spreads an id that many rows carry over several ranges.
    ordered = (
        documents(docs)
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )
    (
        ordered.mapInArrow(encode, STORE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(bloom_fpp))
        .option("orc.row.index.stride", str(stride_rows))
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """The stored rows; with ``doc_ids`` only theirs, found through row indexes and Bloom filters."""
    stored = spark.read.schema(STORE_SCHEMA).orc(path)
    return stored if doc_ids is None else stored.where(F.col("doc_id").isin(*doc_ids))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: ``doc_id, start, n_tokens, ids_crc32``, computed from the stored ids.

    ``start`` counts the ids of all documents before it: shard totals (one row per file) are
    summed in shard order and added to the position inside the shard.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            ends, flat = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(), "<i4")
            crcs = [zlib.crc32(memoryview(flat[a:b])) for a, b in zip(ends[:-1], ends[1:])]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("shard"),
                    batch.column("shard_start"),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                ],
                names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"],
            )

    stored = read_tokens(spark, path)
    totals = stored.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    # One row per file of the store, so this window and the broadcast stay small.
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("shard", F.coalesce(before, F.lit(0)).alias("base"))
    rows = stored.select("doc_id", "shard", "shard_start", "ids").mapInArrow(
        digest, "doc_id long, shard int, shard_start long, n_tokens long, ids_crc32 long"
    )
    return rows.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("base") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32"
    )
