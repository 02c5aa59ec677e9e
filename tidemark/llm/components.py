"""Connected components of an edge table by alternating star operations.

Runs of edges are first replaced by stars around their smallest nodes, where
they lie.  Each round then points every node's larger neighbours at its smallest
neighbour, then its smaller ones; the number of rounds grows with the logarithm
of the longest path, and none is needed when the stars do not touch.  Edges stay
distributed: a round is a few joins and aggregates, written to the shared folder
so that lineage stays short.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import materialize

#: Edges that one run holds at a time.
_RUN = 100_000
_STAR = "big long, small long"


def _stars(edges: DataFrame) -> DataFrame:
    """``big, small``: every run of edges as one star per component it has, the smallest node in the middle."""

    def star(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for batch in held:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = find(a), find(b)
                if x != y:
                    root[max(x, y)] = min(x, y)
        arms = [(x, find(x)) for x in list(root)]
        big, small = [x for x, y in arms if x != y], [y for x, y in arms if x != y]
        return pa.record_batch([pa.array(big, pa.int64()), pa.array(small, pa.int64())], names=["big", "small"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _RUN:
                yield star(held)
                held = []
        if held:
            yield star(held)

    return edges.mapInArrow(run, _STAR)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("big", "small").union(edges.select("small", "big")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    moved = both.where(F.col("other") > F.col("node")).join(least, "node")
    return moved.select(F.col("other").alias("big"), F.col("least").alias("small"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("big").agg(F.min("small").alias("least"))
    moved = edges.join(least, "big").where(F.col("small") != F.col("least"))
    return moved.select(F.col("small").alias("big"), F.col("least").alias("small")).union(least.toDF("big", "small")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars apart: each larger node has one edge, and none is the middle of another star."""
    ends = edges.select(F.col("big").alias("node"), F.lit(1).alias("arms"), F.lit(0).alias("middle")).union(
        edges.select("small", F.lit(0), F.lit(1))
    )
    nodes = ends.groupBy("node").agg(F.sum("arms").alias("arms"), F.max("middle").alias("middle"))
    return not nodes.agg(F.max(F.col("arms") + F.col("middle") * (F.col("arms") > 0).cast("int")) > 1).first()[0]


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its smallest node.

    ``edges`` has two id columns in any direction; loops and nulls do not count.  No edges give no rows.
    """
    a, b = edges.columns[:2]
    now = edges.where(F.col(a) != F.col(b)).select(F.col(a).cast("long"), F.col(b).cast("long"))
    now = materialize(_stars(now).distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            roots = now.select(F.col("small").alias("node")).distinct()
            return now.toDF("node", "component").unionByName(roots.withColumn("component", F.col("node")))
        now = materialize(_small_star(_large_star(now)), "edges")
    raise RuntimeError("the components did not settle")
