"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are joined on shared runs of words (seeds).  For a
pair that shares enough, running Karp-Rabin matching with a falling search
length repeatedly marks the longest matches that do not overlap marked words.
The share of the item that tiles cover decides; their order does not matter,
so reordered passages are caught too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import slices
from tidemark.llm.words import hash_words, mix

MIN_MATCH = 5
COVERAGE = 0.6
HIT_SCHEMA = "doc_id long, item_id long, coverage double, matched_words int, item_words int, tiles int, contaminated boolean"

_MARKS = bytes(32 if b < 128 and not chr(b).isalnum() else b for b in range(256))
_POWER = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(int(_POWER), -1, 1 << 64))
_FILTER_BITS = 22


def plain_words(text: str | None) -> list[bytes]:
    """Words in lower case; ASCII marks separate words like white space."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_MARKS).split() if text else []


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash per word of all texts in order, and the number of words per text."""
    words: list[bytes] = []
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = plain_words(text)
        sizes[i] = len(found)
        words += found
    if not words:
        return np.empty(0, np.uint64), sizes
    flat = np.empty(len(words), object)
    flat[:] = words
    codes, distinct = pd.factorize(flat)
    return mix(hash_words(distinct))[codes], sizes


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` words, by differences of one running sum."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_POWER, len(words)), dtype=np.uint64)))
        return (sums[length:] - sums[:n]) * _powers(_BACK, n)


def tiles(item: np.ndarray, text: np.ndarray, shortest: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (start in item, start in text, length) of two word sequences, each of ``shortest`` words or more."""
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    out: list[tuple[int, int, int]] = []
    length = max(shortest, len(item))
    while True:
        longest, matches = _scan(item, text, free_item, free_text, length)
        if longest > 2 * length:
            length = longest
            continue
        matches.sort(key=lambda m: (-m[2], m[0], m[1]))
        while matches:
            i, j, n = matches.pop(0)
            # Tiles marked meanwhile may cut a match; what is left and long enough waits for its turn.
            open_ = free_item[i : i + n] & free_text[j : j + n]
            if open_.all():
                free_item[i : i + n] = free_text[j : j + n] = False
                out.append((i, j, n))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([0], open_.view(np.int8), [0]))))
            rest = [(i + a, j + a, b - a) for a, b in zip(edges[::2], edges[1::2]) if b - a >= length]
            if rest:
                matches += rest
                matches.sort(key=lambda m: (-m[2], m[0], m[1]))
        if length <= shortest:
            return out
        length = max(shortest, length // 2)


def _scan(item, text, free_item, free_text, length: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Longest maximal match of unmarked words, and all of them; stops early at one of more than twice ``length``."""
    left, right = window_hashes(item, length), window_hashes(text, length)
    if not len(left) or not len(right):
        return 0, []
    whole = lambda free, n: np.convolve(free, np.ones(length, np.int64), "valid")[:n] == length
    at = np.flatnonzero(np.isin(right, left) & whole(free_text.astype(np.int64), len(right)))
    where: dict[int, list[int]] = {}
    for j in at.tolist():
        where.setdefault(int(right[j]), []).append(j)
    longest, matches = 0, []
    for i in np.flatnonzero(whole(free_item.astype(np.int64), len(left))).tolist():
        for j in where.get(int(left[i]), ()):
            if i and j and free_item[i - 1] and free_text[j - 1] and item[i - 1] == text[j - 1]:
                continue  # part of a longer match found before
            n = min(len(item) - i, len(text) - j)
            good = (item[i : i + n] == text[j : j + n]) & free_item[i : i + n] & free_text[j : j + n]
            n = n if good.all() else int(good.argmin())
            if n < length:
                continue  # equal hashes of different words
            if n > 2 * length:
                return n, []
            longest = max(longest, n)
            matches.append((i, j, n))
    return longest, matches


@dataclass
class Items:
    """Benchmark items with their seeds in hash order and a filter on some bits of the hash."""

    ids: list[int | None]
    words: list[np.ndarray]
    seed: np.ndarray
    seed_item: np.ndarray
    seed_at: np.ndarray
    filter: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]], shortest: int) -> Items:
        hashes, sizes = word_hashes([t for _, t in rows])
        words = np.split(hashes, np.cumsum(sizes)[:-1]) if rows else []
        seeds = [window_hashes(w, shortest) for w in words]
        item = np.repeat(np.arange(len(rows)), [len(s) for s in seeds])
        at = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.empty(0, np.int64)
        seed = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        order = np.argsort(seed, kind="stable")
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[(seed >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return cls([i for i, _ in rows], words, seed[order], item[order], at[order], bits)

    def hits(self, texts: list[str | None], shortest: int, coverage: float) -> list[tuple[int, int, float, int, int, int]]:
        """(row, item, coverage, matched words, item words, tiles) of every text and item above the threshold."""
        words, sizes = word_hashes(texts)
        if not len(self.seed) or not len(words):
            return []
        ends = np.cumsum(sizes)
        # Runs of all texts at once, in stretches that keep the running sums short; those across two texts do not count.
        found = []
        for a in range(0, len(words), 1 << 16):
            window = window_hashes(words[a : a + (1 << 16) + shortest - 1], shortest)
            at = np.flatnonzero(self.filter[(window >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            lo = np.searchsorted(self.seed, window[at])
            at = at[(lo < len(self.seed)) & (self.seed[np.minimum(lo, len(self.seed) - 1)] == window[at])]
            found.append(np.stack((at + a, window[at].view(np.int64))))
        at, value = np.concatenate(found, 1)
        row = np.searchsorted(ends, at, "right")
        inside = at + shortest <= ends[row] if len(at) else np.zeros(0, bool)
        row, value = row[inside], value[inside].view(np.uint64)
        lo, hi = np.searchsorted(self.seed, value, "left"), np.searchsorted(self.seed, value, "right")
        shared: dict[tuple[int, int], set[int]] = {}
        for r, a, b in sorted(set(zip(row.tolist(), lo.tolist(), hi.tolist()))):
            for k in range(a, b):
                shared.setdefault((r, int(self.seed_item[k])), set()).add(int(self.seed_at[k]))
        out = []
        for (r, item), starts in shared.items():
            target = self.words[item]
            reach = np.zeros(len(target), bool)  # no tile can cover more than the seeds do
            for s in starts:
                reach[s : s + shortest] = True
            if reach.sum() < coverage * len(target):
                continue
            made = tiles(target, words[ends[r] - sizes[r] : ends[r]], shortest)
            matched = sum(n for *_, n in made)
            if matched >= coverage * len(target):
                out.append((r, item, matched / len(target), matched, len(target), len(made)))
        return out


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, str | None]]]:
    """Items in blocks of about ``block_bytes`` of text, dealt by a hash; each is read by itself."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, -(-size // block_bytes))
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0], r[1] or ""))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE, shortest: int = MIN_MATCH, block_bytes: int = 8_000_000
) -> DataFrame:
    """``doc_id, item_id, coverage, matched_words, item_words, tiles, contaminated`` of every pair at the threshold or above.

    The benchmark is the query set: it is taken in blocks of bounded size, each against all documents, whose texts
    are read whole and never shuffled.  Null and empty texts match nothing, nor do items of fewer than ``shortest`` words.
    Repeated documents are reported each, a repeated item once.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    result = None
    for rows in _blocks(benchmark, block_bytes):
        sent = spark.sparkContext.broadcast(Items.of(rows, shortest))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in slices(batches, "text"):
                hits = items.hits(batch.column("text").to_pylist(), shortest, coverage)
                doc = batch.column("doc_id").take(pa.array([h[0] for h in hits], pa.int64()))
                cells = [pa.array([items.ids[h[1]] for h in hits], pa.int64()), pa.array([h[2] for h in hits], pa.float64())]
                cells += [pa.array([h[k] for h in hits], pa.int32()) for k in (3, 4, 5)]
                yield pa.record_batch(
                    [doc, *cells, pa.array([True] * len(hits), pa.bool_())],
                    names=[c.split()[0] for c in HIT_SCHEMA.split(", ")],
                )

        found = source.mapInArrow(run, HIT_SCHEMA)
        result = found if result is None else result.unionByName(found)
    return result


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, *, coverage: float = COVERAGE, shortest: int = MIN_MATCH, block_bytes: int = 8_000_000
) -> DataFrame:
    """The documents without those that ``find_leaks`` reports, in all their columns; nothing is shuffled."""
    for rows in _blocks(benchmark, block_bytes):
        sent = docs.sparkSession.sparkContext.broadcast(Items.of(rows, shortest))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, "text"):
                hits = {h[0] for h in sent.value.hits(batch.column("text").to_pylist(), shortest, coverage)}
                yield batch.filter(pa.array([i not in hits for i in range(batch.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
