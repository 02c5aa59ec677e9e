"""Near-duplicate detection with an LSH forest and exact confirmation.

Documents with equal shingle sets are one class; one representative of each goes
on.  The forest holds several sorted orders of the representatives' MinHash
signatures, each by hashes of its own.  A range partitioning on the whole key
(tree, hashes, id) sorts every order, so a region of very many alike
signatures is cut like any other.  Candidates are neighbours with a longest
common prefix: in a sparse region the prefix is one hash, in a dense one the
neighbours in reach share many, so the depth adapts to the region.  Signatures
then tell hopeless pairs apart, and links are confirmed on full shingle sets.

Documents whose first hash more than ``REACH`` share may have partners out of
reach.  A second pass finds these exactly: pairs that share a rare shingle by a
prefix filter, and pairs that share common shingles only by their overlaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.storage import documents, materialize, slices
from tidemark.llm.words import mix, shingle_sets

SHINGLE = 5
PERCENT = 75
TREES, DEPTH = 12, 8
#: Rows before it that a row meets in its region; of a longer region's pairs, the most alike ones that each row keeps.
REACH, NEAR = 48, 5
#: Shingles of at most so many crowded documents count as rare; crowded documents on each side of a cell.
RARE, CELL = 48, 500
#: Estimated similarity below which a pair is not looked at, and from which links may stand for others: four
#: deviations of an estimate from the threshold, and three.
HOPELESS, CONFIDENT = 0.55, 0.88

SKETCH_SCHEMA = "doc_id long, n_shingles long, set_key binary, signature binary"
PAIR_SCHEMA = "a long, b long, alike double"
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("alike", pa.float64())])


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    base = mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return base[:count] | np.uint64(1), base[count:]


def minhash(sets: np.ndarray, sizes: np.ndarray, count: int = TREES * DEPTH) -> np.ndarray:
    """``count`` 32-bit minima per set (rows); empty sets have all ones."""
    out = np.full((len(sizes), count), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    starts = (np.cumsum(sizes) - sizes)[filled]
    multiply, add = _seeds(count)
    with np.errstate(over="ignore"):
        for k in range(count):
            value = ((sets * multiply[k] + add[k]) >> np.uint64(32)).astype(np.uint32)
            out[filled, k] = np.minimum.reduceat(value, starts)
    return out


def sketch(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, set_key, signature`` of every document; the key is equal for equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets, sizes = shingle_sets(batch.column("text").to_pylist(), width)
            signature = minhash(sets, sizes)
            starts = np.cumsum(sizes) - sizes
            with np.errstate(over="ignore"):
                halves = [np.add.reduceat(np.append(mix(sets ^ np.uint64(s)), np.uint64(0)), starts) for s in (1, 2)]
            keys = np.stack([*halves, sizes.astype(np.uint64)], 1)
            keys[sizes == 0] = 0
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([s.tobytes() for s in signature], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "set_key", "signature"],
            )

    return documents(docs).mapInArrow(run, SKETCH_SCHEMA)


def forest(representatives: DataFrame) -> DataFrame:
    """One row per tree and representative: its hashes in the tree's order and a byte of every hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw = b"".join(batch.column("signature").to_pylist())
            signature = np.frombuffer(raw, np.uint32).reshape(n, TREES * DEPTH)
            short = [s.tobytes() for s in signature.astype(np.uint8)]
            keys = signature.reshape(n, TREES, DEPTH).astype(">u4")
            for tree in range(TREES):
                yield pa.record_batch(
                    [
                        pa.array(np.full(n, tree, np.int32)),
                        pa.array([k.tobytes() for k in keys[:, tree]], pa.binary()),
                        batch.column("doc_id"),
                        pa.array(short, pa.binary()),
                    ],
                    names=["tree", "path", "doc_id", "short"],
                )

    return representatives.select("doc_id", "signature").mapInArrow(run, "tree int, path binary, doc_id long, short binary")


def _columns(batches: list[pa.RecordBatch] | pa.Table) -> tuple[np.ndarray, ...]:
    table = batches if isinstance(batches, pa.Table) else pa.Table.from_batches(batches)
    n = table.num_rows
    path = np.frombuffer(b"".join(table["path"].to_pylist()), ">u4").reshape(n, DEPTH).astype(np.uint32)
    short = np.frombuffer(b"".join(table["short"].to_pylist()), np.uint8).reshape(n, TREES * DEPTH)
    return table["tree"].to_numpy(), path, table["doc_id"].to_numpy(), short


def _neighbours(tree: np.ndarray, path: np.ndarray, doc: np.ndarray, short: np.ndarray) -> pa.RecordBatch:
    """Pairs among rows in the order of (tree, path, id).

    Each row meets the rows up to ``REACH`` before it that share its first hash, which are those with the longest common
    prefix, and beyond them the first row of every run of equal prefixes it is in, whatever the run's length.  A row's
    nearest confident partner is its parent; rows under one root are connected, so no other pair among them is needed.
    Of a region longer than ``REACH`` only pairs among the ``NEAR`` most alike ones of either row go on: the region is
    crowded in the whole table too, so the second pass finds all links that these leave open.
    """
    n = len(doc)
    here = np.arange(n)

    def alike_of(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i))
        for k in range(0, len(i), 20_000):
            out[k : k + 20_000] = (short[i[k : k + 20_000]] == short[j[k : k + 20_000]]).mean(1)
        return (out - 1 / 256) / (1 - 1 / 256)  # bytes agree by chance once in 256

    shared = np.zeros(n, np.int64)  # longest common prefix with the row before
    if n > 1:
        equal = np.logical_and.accumulate(path[1:] == path[:-1], axis=1).sum(1)
        shared[1:] = np.where(tree[1:] == tree[:-1], equal, 0)
    region = np.cumsum(shared == 0)
    met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    parent, strength = here.copy(), np.zeros(n)

    def meet(i: np.ndarray, j: np.ndarray) -> None:
        alike = alike_of(i, j)
        sure = (alike >= CONFIDENT) & (parent[i] == i)
        parent[i[sure]], strength[i[sure]] = j[sure], alike[sure]
        some = (alike >= HOPELESS) & ~sure
        met.append((i[some], j[some], alike[some]))

    now = here
    for step in range(1, REACH + 1):
        now = now[now >= step]
        now = now[region[now] == region[now - step]]
        if not len(now):
            break
        meet(now, now - step)
    before = np.full(n, -1, np.int64)
    for depth in range(1, DEPTH + 1):
        start = np.maximum.accumulate(np.where(shared >= depth, 0, here))
        rows = np.flatnonzero((here - start > REACH) & (start != before))
        before = start
        if len(rows):
            meet(rows, start[rows])
    child = np.flatnonzero(parent != here)
    pairs = [(child, parent[child], strength[child])]
    root = parent.copy()
    while len(root) and (root[root] != root).any():  # parents come before their rows, so this ends
        root = root[root]
    if met:
        i, j, alike = (np.concatenate(x) for x in zip(*met))
        apart = root[i] != root[j]
        i, j, alike = i[apart], j[apart], alike[apart]
        keep = np.bincount(region)[region[i]] <= REACH
        for end in (i, j):
            by = np.lexsort((-alike, end))
            first = np.searchsorted(end[by], end[by])
            keep[by[np.arange(len(by)) - first < NEAR]] = True
        pairs.append((i[keep], j[keep], alike[keep]))
    i, j, score = (np.concatenate(x) for x in zip(*pairs))
    a, b = doc[i], doc[j]
    other = a != b
    a, b, score = a[other], b[other], score[other]
    return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(score)], schema=_PAIR)


def candidates(representatives: DataFrame, rows_per_task: int = 60_000) -> DataFrame:
    """Candidate pairs ``a < b`` with their estimated similarity, from all sorted orders.

    The sorted rows lie in ranges of about ``rows_per_task``.  The last rows of a range and the first of the next
    meet in a second step.
    """
    ranges = max(1, representatives.count() * TREES // rows_per_task)
    rows = forest(representatives).repartitionByRange(ranges, "tree", "path", "doc_id")
    rows = rows.sortWithinPartitions("tree", "path", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        part, columns = TaskContext.get().partitionId(), _columns(held)
        table, n = pa.Table.from_batches(held).select(["tree", "path", "doc_id", "short"]), len(columns[0])
        pairs = _neighbours(*columns)
        blank = lambda k: [pa.nulls(k, t) for t in (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary())]
        yield pa.record_batch([*pairs.columns, *blank(pairs.num_rows)], schema=_FOUND)
        for border, edge in ((part - 1, table.slice(0, REACH)), (part, table.slice(max(0, n - REACH)))):
            k = edge.num_rows
            cells = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.array(np.full(k, border, np.int32))]
            yield pa.record_batch([*cells, *(c.combine_chunks() for c in edge.columns)], schema=_FOUND)

    def across(edge: pa.Table) -> pa.Table:
        edge = edge.sort_by([(c, "ascending") for c in ("tree", "path", "doc_id")])
        return pa.Table.from_batches([_neighbours(*_columns(edge))])

    found = materialize(rows.mapInArrow(run, FOUND_SCHEMA), "neighbours")
    inside = found.where(F.col("border").isNull()).select("a", "b", "alike")
    borders = found.where(F.col("border").isNotNull()).groupBy("border").applyInArrow(across, PAIR_SCHEMA)
    return inside.unionByName(borders).groupBy("a", "b").agg(F.max("alike").alias("alike"))


FOUND_SCHEMA = f"{PAIR_SCHEMA}, border int, tree int, path binary, doc_id long, short binary"
_FOUND = pa.schema(
    [*_PAIR, ("border", pa.int32()), ("tree", pa.int32()), ("path", pa.binary()), ("doc_id", pa.int64()), ("short", pa.binary())]
)


def confirm(pairs: DataFrame, docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, per_cell: int = 4000) -> DataFrame:
    """Links ``a, b`` among candidate pairs whose full shingle sets are similar enough.

    Pairs of one candidate component are confirmed in one cell, so each document's text travels once; a large
    component is dealt into more cells by its pairs.  Within a cell, pairs that confirmed links already connect are skipped.
    """
    labels = connected_components(pairs.select("a", "b"))
    # Read twice below, for the components' sizes and for the pairs; stored, so that every pair meets its label once.
    labelled = materialize(pairs.join(labels.withColumnRenamed("node", "a"), "a"), "labelled")
    cells = labelled.groupBy("component").agg(F.ceil(F.count("*") / per_cell).alias("parts"))
    dealt = labelled.join(cells, "component").select(
        "a", "b", "alike", "component", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part")
    )
    dealt = materialize(dealt, "cells")
    needs = (
        dealt.select("component", "part", F.col("a").alias("doc_id"))
        .union(dealt.select("component", "part", F.col("b").alias("doc_id")))
        .distinct()
    )
    texts = needs.join(documents(docs).hint("merge"), "doc_id")  # alike at every size

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets, sizes = shingle_sets(batch.column("text").to_pylist(), width)
            ends = np.cumsum(sizes)
            raw = [sets[e - n : e].tobytes() for e, n in zip(ends, sizes)]
            yield pa.record_batch(
                [batch.column("component"), batch.column("part"), batch.column("doc_id"), pa.array(raw, pa.binary())],
                names=["component", "part", "doc_id", "shingles"],
            )

    members = texts.select("component", "part", "doc_id", "text").mapInArrow(
        sets_of, "component long, part long, doc_id long, shingles binary"
    )

    def check(left: pa.Table, right: pa.Table) -> pa.Table:
        sets: dict[int, list[np.ndarray]] = {}
        for doc, raw in zip(right["doc_id"].to_pylist(), right["shingles"].to_pylist()):
            sets.setdefault(doc, []).append(np.frombuffer(raw, np.uint64))
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        left = left.sort_by([("alike", "descending"), ("a", "ascending"), ("b", "ascending")])
        out: tuple[list[int], list[int]] = ([], [])
        for a, b in zip(left["a"].to_pylist(), left["b"].to_pylist()):
            x, y = find(a), find(b)
            if x != y and any(similar(s, t, percent) for s in sets.get(a, ()) for t in sets.get(b, ())):
                root[max(x, y)] = min(x, y)
                out[0].append(a)
                out[1].append(b)
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    keys = ("component", "part")
    return dealt.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInArrow(check, "a long, b long")


def similar(s: np.ndarray, t: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets overlap by ``percent`` of their union; empty sets are like nothing."""
    if not len(s) or not len(t) or 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    both = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * both >= percent * (len(s) + len(t) - both)


def crowded(representatives: DataFrame) -> DataFrame:
    """``doc_id, hub``: documents in a region (equal first hash in a tree) longer than the reach, and the region's smallest id.

    A pair in no such region has met all of its regions in full, so only pairs of these documents can be out of reach.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw = b"".join(batch.column("signature").to_pylist())
            heads = np.frombuffer(raw, np.uint32).reshape(n, TREES, DEPTH)[:, :, 0].astype(np.int64)
            heads = heads + (np.arange(TREES, dtype=np.int64) << 32)
            docs = np.repeat(batch.column("doc_id").to_numpy(), TREES)
            yield pa.record_batch([pa.array(heads.ravel()), pa.array(docs)], names=["head", "doc_id"])

    heads = representatives.select("doc_id", "signature").mapInArrow(run, "head long, doc_id long")
    long = heads.groupBy("head").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).where(F.col("n") > REACH)
    return heads.join(long, "head").select("doc_id", "hub").distinct()


def crowd_shingles(crowd: DataFrame, docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, size, rare, common`` of every text of crowded documents.

    ``rare`` are the rare shingles of the prefix, rarest first, in which a pair over the threshold shares its rarest common
    shingle; ``common`` are all others that more than ``RARE`` texts have.  A shingle of one text is in neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets, sizes = shingle_sets(batch.column("text").to_pylist(), width)
            offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
            shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sets.view(np.int64)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("version"), pa.array(sizes.astype(np.int64)), shingles],
                names=["doc_id", "version", "size", "shingles"],
            )

    texts = documents(docs).join(crowd.select("doc_id").distinct(), "doc_id", "left_semi")
    texts = texts.select("doc_id", F.xxhash64("text").alias("version"), "text")
    sets = texts.mapInArrow(run, "doc_id long, version long, size long, shingles array<long>").where("size > 0")
    rows = sets.select("doc_id", "version", "size", F.explode("shingles").alias("shingle"))
    rows = materialize(rows, "crowd-shingles")
    spread = rows.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    # A row repeated with equal text has its shingles twice; the set keeps one of each.
    sets = rows.join(spread, "shingle").groupBy("doc_id", "version", "size").agg(
        F.sort_array(F.collect_set(F.struct("n", "shingle"))).alias("shared")
    )
    need = F.ceil(F.col("size") * percent / 100)
    prefix = F.greatest(F.size("shared") - need + 1, F.lit(0)).cast("int")  # shingles of one text come first
    return sets.select(
        "doc_id",
        "size",
        F.filter(F.slice("shared", F.lit(1), prefix), lambda x: x["n"] <= RARE)["shingle"].alias("rare"),
        F.filter("shared", lambda x: x["n"] > RARE)["shingle"].alias("common"),
    )


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of every left and every right set."""
    out = np.zeros((len(left), len(right)), np.float32)
    sides = [(np.repeat(np.arange(len(x)), [len(s) for s in x]), np.concatenate(x)) for x in (left, right)]
    both = np.intersect1d(sides[0][1], sides[1][1])
    for k in range(0, len(both), 4000):
        some = both[k : k + 4000]
        ones = []
        for (row, value), n in zip(sides, out.shape):
            at = np.minimum(np.searchsorted(some, value), len(some) - 1)
            hit = some[at] == value
            m = np.zeros((n, len(some)), np.float32)
            m[row[hit], at[hit]] = 1
            ones.append(m)
        out += ones[0] @ ones[1].T
    return out


def common_links(sets: DataFrame, crowd: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` among texts of one region whose common shingles alone overlap enough, unless links connect them already.

    ``sets`` have a ``label`` by the links known so far.  Every two such texts are compared, in cells of bounded size; a
    cell gives at most one link per document.
    """
    sets = sets.where(100 * F.size("common") >= percent * F.col("size"))
    inside = crowd.join(sets.select("doc_id").distinct(), "doc_id", "left_semi")
    regions = connected_components(inside.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")))
    sets = materialize(sets.join(regions.withColumnsRenamed({"node": "doc_id", "component": "region"}), "doc_id"), "common-sets")
    parts = sets.groupBy("region").agg(
        F.ceil(F.greatest(F.count("*") / CELL, F.sum("size") / (CELL * 2000))).alias("parts"), F.count_distinct("label").alias("labels")
    )
    dealt = sets.join(parts.where("labels > 1"), "region").withColumn("part", F.pmod(F.xxhash64("doc_id", "size"), F.col("parts")))
    other = dealt.select("region", "part", "doc_id", "label", "size", "common", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o"))
    cells = other.select(
        "region", F.least("part", "o").alias("i"), F.greatest("part", "o").alias("j"), "part", "doc_id", "label", "size", "common"
    )

    def compare(cell: pa.Table) -> pa.Table:
        part, doc, label, size = (cell[c].to_numpy() for c in ("part", "doc_id", "label", "size"))
        i, j = cell["i"][0].as_py(), cell["j"][0].as_py()
        flat, ends = cell["common"].combine_chunks(), np.cumsum(cell["common"].combine_chunks().value_lengths().to_numpy())
        lists = np.split(flat.flatten().to_numpy(), ends[:-1])
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        out: tuple[list[int], list[int]] = ([], [])
        if len(left) and len(right):
            both = _overlaps([lists[x] for x in left], [lists[x] for x in right])
            union = size[left][:, None] + size[right][None] - both
            x, y = np.nonzero((100 * both >= percent * union) & (label[left][:, None] != label[right][None]))
            root: dict[int, int] = {}

            def find(n: int) -> int:
                while root.setdefault(n, n) != n:
                    root[n] = n = root[root[n]]
                return n

            for a, b in zip(left[x].tolist(), right[y].tolist()):
                p, q = find(label[a]), find(label[b])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    out[0].append(min(doc[a], doc[b]))
                    out[1].append(max(doc[a], doc[b]))
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return cells.groupBy("region", "i", "j").applyInArrow(compare, "a long, b long")


def crowd_links(representatives: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Links ``a, b`` that pairs out of reach add to known ones, whose components are ``labels``."""
    crowd = materialize(crowded(representatives), "crowd")
    labels = labels.withColumnsRenamed({"node": "doc_id", "component": "label"})
    sets = crowd_shingles(crowd, docs).join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    sets = materialize(sets, "crowd-sets")
    rare = sets.select("doc_id", "label", "size", F.explode("rare").alias("shingle"))
    pairs = rare.alias("x").join(rare.alias("y"), "shingle").where(
        (F.col("x.doc_id") < F.col("y.doc_id"))
        & (F.col("x.label") != F.col("y.label"))
        & (100 * F.least("x.size", "y.size") >= PERCENT * F.greatest("x.size", "y.size"))
    )
    pairs = pairs.select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct().withColumn("alike", F.lit(0.0))
    found = confirm(materialize(pairs, "rare-pairs"), docs)
    return found.unionByName(common_links(sets.select("doc_id", "label", "size", "common"), crowd))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document.

    Documents are linked when their sets of five-word shingles overlap by three quarters of their union; a component is
    named by its smallest id, whose document is kept.  Null and empty texts have no shingles and are linked with
    nothing, nor are rows without an id (component null, kept).  Rows repeated under one id are one document: they share
    the component.  Other columns are ignored; an empty table gives no rows.
    """
    sketches = materialize(sketch(docs), "sketches")
    linked = sketches.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = linked.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    classes = materialize(classes, "classes")
    representatives = sketches.select("doc_id", "set_key", "signature").join(classes, ["doc_id", "set_key"]).dropDuplicates(["doc_id", "set_key"])
    representatives = materialize(representatives.select("doc_id", "signature"), "representatives")
    pairs = materialize(candidates(representatives), "pairs")
    labels = connected_components(materialize(confirm(pairs, docs), "links"))
    more = materialize(crowd_links(representatives, docs, labels), "crowd-links")
    labels = connected_components(labels.toDF("a", "b").unionByName(more))
    named = classes.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "set_key", F.coalesce("component", "doc_id").alias("component_id")
    )
    # A class may hold a third of all rows; the join's rows of one key are split by adaptive execution.
    rows = sketches.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_key")).alias("set_key"))
    joined = rows.join(named, "set_key", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents that stay, one of each component, in all their columns."""
    kept = deduplicate(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(F.col("kept_id")), "left_semi")
