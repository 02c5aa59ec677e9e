"""Best-fit packing planned on a histogram of lengths.

The plan never sees a document: it places *counts* of pieces of each length
(at most ``capacity`` lengths) by best fit, longest first.  A plan row says
which ranks of a length go to which sequences; pieces get a rank within their
length and take their slot by joining on it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import documents, materialize, slices
from tidemark.llm.tokens import END_ID, encoder, vocabulary_path

CAPACITY = 1024
PIECE_SCHEMA = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, shard int, shard_rank long"
)
PLAN_SCHEMA = "length long, rank_from long, rank_to long, first_sequence long, per_sequence long, first_offset long"


@dataclass(frozen=True)
class Run:
    """Ranks ``rank_from`` to ``rank_to`` (excluded) of one length fill sequences in order."""

    length: int
    rank_from: int
    rank_to: int
    first_sequence: int
    per_sequence: int
    first_offset: int


def plan_best_fit(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best fit, longest first, over counts.

    Sequences filled alike are kept as intervals of numbers per free space, so the work and the
    plan depend on the number of lengths, not of pieces.  Placing a piece in the tightest open
    sequence leaves that one the tightest while the length still fits, so each takes
    ``free // length`` pieces at once.
    """
    runs: list[Run] = []
    open_: defaultdict[int, list[tuple[int, int]]] = defaultdict(list)  # free space -> (first, count)
    spaces: list[int] = []  # free spaces in use, ascending
    sequences = 0

    def add(free: int, first: int, count: int) -> None:
        if free and count:
            if free not in open_:
                insort(spaces, free)
            open_[free].append((first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                free = spaces[at]
                first, count = open_[free].pop()
                if not open_[free]:
                    del open_[free], spaces[at]
            else:
                free, first = capacity, sequences
                count = -(-left // (capacity // length))
                sequences += count
            per = free // length
            whole = min(count, left // per)
            rest = left - whole * per if whole < count else 0
            for start, n, each in ((first, whole, per), (first + whole, 1, min(rest, per))):
                if n and each:
                    runs.append(Run(length, rank, rank + n * each, start, each, capacity - free))
                    add(free - each * length, start, n)
                    rank, left = rank + n * each, left - n * each
            used = whole + (1 if rest else 0)
            add(free, first + used, count - used)
    return runs


def cut_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their length, checksum and rank within (shard, length).

    A document of more than ``capacity`` ids is cut into pieces of that length, the first may be shorter.
    """
    source = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard = encoder(source), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, sizes = enc.encode(batch.column("text").to_pylist(), END_ID)
            ids = np.ascontiguousarray(ids, "<i4")
            pieces = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = sizes - (pieces - 1) * capacity  # length of the first piece
            start = np.where(number == 0, 0, head[row] + (number - 1) * capacity)
            length = np.where(number == 0, head[row], capacity)
            base = (np.cumsum(sizes) - sizes)[row] + start
            crcs = [zlib.crc32(memoryview(ids[a : a + n])) for a, n in zip(base, length)]
            order = np.argsort(length, kind="stable")
            rank = np.empty(len(row), np.int64)
            counts = np.bincount(length, minlength=capacity + 1)
            rank[order] = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(seen, counts)
            seen += counts
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    pa.array(crcs, pa.int64()),
                    pa.array(np.full(len(row), shard, np.int32)),
                    pa.array(rank),
                ],
                names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")],
            )

    return documents(docs).mapInArrow(cut, PIECE_SCHEMA)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document.

    Null text is empty (its only id is the end id).  Repeated rows and repeated ids are packed each;
    other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = materialize(cut_documents(docs, vocabulary, capacity), "pieces")
    shares = materialize(pieces.groupBy("length", "shard").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = [
        (r.length, r.rank_from, r.rank_to, r.first_sequence, r.per_sequence, r.first_offset)
        for r in plan_best_fit(histogram, capacity)
    ]
    plan = spark.createDataFrame(runs, PLAN_SCHEMA)
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shares.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "shard"]).withColumn("rank", F.col("base") + F.col("shard_rank"))
    # The plan has a few rows per length, whatever the number of documents.
    placed = ranked.join(
        F.broadcast(plan.withColumnRenamed("length", "plan_length")),
        (F.col("length") == F.col("plan_length"))
        & (F.col("rank") >= F.col("rank_from"))
        & (F.col("rank") < F.col("rank_to")),
    )
    step = F.col("rank") - F.col("rank_from")
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.floor(step / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (step % F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )
