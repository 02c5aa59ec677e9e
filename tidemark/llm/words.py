"""Words of whole texts as bytes, with a 64-bit hash per word, batch by batch.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]`` after lower-casing A-Z;
bytes of other letters stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

MIX = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_table(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words in order, the distinct words they stand for, and the number of words per text."""
    words: list[bytes] = []
    sizes = np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        found = split_words(text)
        sizes[i] = len(found)
        words += found
    flat = np.empty(len(words), object)
    flat[:] = words
    codes, distinct = pd.factorize(flat)
    return codes.astype(np.int64), distinct, sizes


def hash_words(distinct: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word that is the same in every process."""
    if not len(distinct):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.asarray([w.decode("utf-8", "surrogateescape") for w in distinct], object), categorize=False)


def shingle_sets(texts: Sequence[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, in one flat array, and their number per text.

    A text with fewer than ``width`` words has one shingle, the whole sequence; one without words has none.
    """
    codes, distinct, sizes = word_table(texts)
    hashes = mix(hash_words(distinct))[codes] if len(codes) else np.empty(0, np.uint64)
    count = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), count)
    first = (ends - sizes)[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    span = np.minimum(sizes[row], width)
    value = mix(span.astype(np.uint64) + MIX)
    with np.errstate(over="ignore"):
        for k in range(width):
            at = np.minimum(first + k, max(len(hashes) - 1, 0))
            step = mix(value * MIX + (hashes[at] if len(hashes) else np.uint64(0)))
            value = np.where(k < span, step, value)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[fresh], np.bincount(row[fresh], minlength=len(sizes)).astype(np.int64)
