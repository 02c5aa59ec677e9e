"""Divergence of each source's words from the other sources of its language and from the whole language.

``bytes.translate`` lowers A-Z and turns every other character below 128 that is no letter into a space, in one pass;
``bytes.split`` gives the terms, and a ``Counter`` per document their frequencies.  Tasks add these up per language,
source and term, so that only sums are shuffled.

Only terms that a source has are ever listed.  A term that it lacks has the same smoothed share as every other one that it
lacks, so a sum over all terms of a language is a constant for two absent terms, plus corrections for the terms that one
source has, plus corrections for those that both have.  All arithmetic is exact, in integers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import materialize

SCALE = 1_000_000_000
PRIOR = 2
_LETTERS = {*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes((b + 32 if 0x41 <= b < 0x5B else b) if b in _LETTERS else 0x20 for b in range(256))
_CELLS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("docs", pa.int64())])
CELL_SCHEMA = "lang string, source string, term string, count long, docs long"
_SHARED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("value", pa.int64())])
SHARED_SCHEMA = "lang string, source string, other string, value long"


def tokenize(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8: runs of letters A-Z, lower-cased, and of characters from 128 on."""
    return text.translate(_TABLE).split()


class _Totals:
    """Occurrences and documents per (language, source, term), added up over documents until ``limit`` cells are held."""

    def __init__(self, limit: int) -> None:
        self._limit = limit
        self._clear()

    def _clear(self) -> None:
        self._count: dict[tuple[str, str], Counter] = {}
        self._docs: dict[tuple[str, str], Counter] = {}
        self._rows: Counter = Counter()
        self._held = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        frequencies = Counter(tokenize(text))
        group = (lang, source)
        count, docs = self._count.setdefault(group, Counter()), self._docs.setdefault(group, Counter())
        before = len(docs)
        docs.update(frequencies.keys())
        for term, n in frequencies.items():
            count[term] += n
        self._rows[group] += 1
        self._held += len(docs) - before

    def full(self) -> bool:
        return self._held >= self._limit

    def drain(self) -> Iterator[pa.RecordBatch]:
        """The cells held, and per group one without a term that carries its number of documents."""
        for group, rows in self._rows.items():
            count, docs = self._count[group], self._docs[group]
            terms = pa.array([b"", *docs], pa.binary()).cast(pa.string())
            size = len(terms)
            columns = [
                pa.array([group[0]] * size, pa.string()), pa.array([group[1]] * size, pa.string()), terms,
                pa.array([0, *map(count.__getitem__, docs)], pa.int64()), pa.array([rows, *docs.values()], pa.int64()),
            ]
            yield pa.record_batch(columns, schema=_CELLS)
        self._clear()


def count_terms(docs: DataFrame, held: int = 250_000) -> DataFrame:
    """``lang, source, term, count, docs``: partial sums per task; the empty term stands for the group itself.

    ``held`` is the number of cells a task keeps before it hands them on; it bounds memory and changes no sum.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = _Totals(held)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
                totals.add(lang, source, text.as_py())
                if totals.full():
                    yield from totals.drain()
        yield from totals.drain()

    return rows.mapInArrow(emit, CELL_SCHEMA)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``; decimals keep the product exact for any counts."""
    product = (count + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.lit(1) + F.call_function("div", product, (total + PRIOR * terms).cast("decimal(20,0)"))


def _gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; shares are at most SCALE + 1, so the square fits."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _np_gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _shared_corrections(batches: Iterator[pa.RecordBatch], held: int) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that two sources have, summed per pair; rows come in order of language and term.

    Sources of one term meet at distances 1, 2, ... within its run, so work follows the pairs that share the term.
    """
    sums: dict[tuple[str, str, str], int] = {}

    def drain() -> pa.RecordBatch:
        langs, sources, others = zip(*sums) if sums else ((), (), ())
        out = pa.record_batch([pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(others, pa.string()),
                               pa.array(list(sums.values()), pa.int64())], schema=_SHARED)
        sums.clear()
        return out

    def meet(run: pa.Table) -> None:
        lang, source = (run.column(n).combine_chunks().dictionary_encode() for n in ("lang", "source"))
        term = run.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        lang_code, source_code = lang.indices.to_numpy().astype(np.int64), source.indices.to_numpy().astype(np.int64)
        share, base = run.column("share").to_numpy(), run.column("base").to_numpy()
        width = len(source.dictionary)
        for distance in range(1, len(term)):
            here = np.flatnonzero((term[:-distance] == term[distance:]) & (lang_code[:-distance] == lang_code[distance:]))
            if not len(here):
                break
            there = here + distance
            p, q, b, c = share[here], share[there], base[here], base[there]
            value = _np_gap(p, q) - _np_gap(p, c) - _np_gap(b, q) + _np_gap(b, c)
            key = (lang_code[here] * width + source_code[here]) * width + source_code[there]
            codes, at = np.unique(key, return_inverse=True)
            total = np.zeros(len(codes), np.int64)
            np.add.at(total, at, value)
            for code, add in zip(codes.tolist(), total.tolist()):
                name = (lang.dictionary[code // width // width].as_py(), source.dictionary[code // width % width].as_py(),
                        source.dictionary[code % width].as_py())
                sums[name] = sums.get(name, 0) + add

    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = now if kept is None else pa.concat_tables([kept, now])
        ends = [now.column(n)[-1].as_py() for n in ("lang", "term")]
        same = pa.compute.and_(pa.compute.equal(now.column("lang"), ends[0]), pa.compute.equal(now.column("term"), ends[1]))
        open_rows = pa.compute.sum(same).as_py()  # the last run may go on in the next batch
        if now.num_rows > open_rows:
            meet(now.slice(0, now.num_rows - open_rows))
        kept = now.slice(now.num_rows - open_rows)
        if len(sums) >= held:
            yield drain()
    if kept is not None:
        meet(kept)
    yield drain()


def audit(docs: DataFrame, *, min_docs: int = 10, top: int = 10) -> DataFrame:
    """``lang, source, part, item, value, rank``: divergences per (language, source), largest first.

    ``part`` is ``pair`` with every other source of the language as ``item``, or ``term`` with the ``top`` kept terms that
    the source uses more than its language does.  Kept are the terms of at least ``min_docs`` rows of the language.
    Null text, language and source count as empty; an empty text makes its group occur; repeated rows count each time;
    ties of value are ranked by item in UTF-8; other columns are ignored; an empty table gives no row.
    """
    # Dealt by language and term: sums per source and per language follow without another shuffle, and only kept terms are written.
    partial = count_terms(docs).repartition("lang", "term")
    cells = partial.groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    cells = cells.withColumns({"lang_count": F.sum("count").over(whole), "lang_docs": F.sum("docs").over(whole)})
    marked = cells.where((F.col("lang_docs") >= min_docs) | (F.col("term") == "")).drop("docs", "lang_docs")
    marked = materialize(marked, "audit-kept")
    used = marked.where(F.col("term") != "")

    occurring = marked.where(F.col("term") == "").select("lang", "source")
    kept = used.groupBy("lang", "term").agg(F.max("lang_count").alias("lang_count"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_count").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    zero = F.lit(0).cast("long")
    sizes = occurring.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("total", zero).alias("total"), F.coalesce("terms", zero).alias("terms"),
        F.coalesce("lang_total", zero).alias("lang_total"),
    )
    # Without a kept term no share is ever used.
    base = F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms"))).otherwise(1)
    groups = materialize(sizes.withColumn("base", base), "audit-groups")

    shares = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "base",
        _share(F.col("count"), F.col("total"), F.col("terms")).alias("share"),
        _share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("lang_share"),
    )
    return _pairs(shares, groups).unionByName(_terms(shares, top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, top: int) -> DataFrame:
    ahead = shares.where(F.col("share") > F.col("lang_share"))
    rows = ahead.select("lang", "source", F.col("term").alias("item"), _gap(F.col("share"), F.col("lang_share")).alias("value"))
    return _ranked(rows, "term").where(F.col("rank") <= top)


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """Every source with every other one of its language: the rows that the report lists, so their number is its size."""
    other = groups.select("lang", F.col("source").alias("other"), F.col("base").alias("other_base"))
    listed = groups.select("lang", "source", "base", "terms").join(other, "lang").where(F.col("source") != F.col("other"))
    absent = listed.select("lang", "source", "other", (F.col("terms") * _gap(F.col("base"), F.col("other_base"))).alias("value"))

    # Terms of one source against the other's share of an absent term: equal shares are one row with a count.
    levels = shares.groupBy("lang", "source", "base", "share").agg(F.count(F.lit(1)).alias("n"))
    one = levels.join(other, "lang").where(F.col("source") != F.col("other"))
    change = F.col("n") * (_gap(F.col("share"), F.col("other_base")) - _gap(F.col("base"), F.col("other_base")))
    alone = one.groupBy("lang", "source", "other").agg(F.sum(change).alias("value"))

    in_order = shares.select("lang", "term", "source", "share", "base").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = in_order.mapInArrow(lambda batches: _shared_corrections(batches, 200_000), SHARED_SCHEMA)

    def mirrored(rows: DataFrame) -> DataFrame:
        return rows.unionByName(rows.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))

    sums = absent.unionByName(mirrored(alone)).unionByName(mirrored(both)).groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    return _ranked(sums.withColumnRenamed("other", "item"), "pair")
