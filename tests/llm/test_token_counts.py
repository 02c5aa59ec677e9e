"""Token counts against the library itself."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.token_counts import TokenCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*"astrevlmdSé中1²'-!_\n\t\0", "ß", "  ", " ", "\u0085", "​", "　", "́", "😀", "İ",
         "'re", "'ll", "'ve", "the", " the", "ing", "<|endoftext|>", "<|endof", "text|>"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def _texts(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    mixed = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(count)]
    letters = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäö") for _ in range(rng.randint(1, 60))) for _ in range(count // 4)]
    return mixed + letters + ["", " ", "a" * 5000, " " * 777 + "x", "=-" * 300, "<|endoftext|>", "x<|endoftext|> y", "don't 'really' we'rex"]


def test_counts_equal_the_library(library):
    texts = _texts(1, 8000)
    assert TokenCounter(PATH).count(texts).tolist() == library(texts)


def test_windows_and_forgetting_change_nothing(library):
    texts = _texts(2, 120)
    small = TokenCounter(PATH, window=50, limit=50)
    small._counts._transducer._limit = 200
    assert small.count(texts).tolist() == library(texts)
    assert small.count(texts).tolist() == library(texts)


def test_chunks_compose(library):
    """One text over many chunks, with pieces across every chunk's edge."""
    rng = random.Random(3)
    text = "".join(rng.choice(["'", "r", "e", "l", " ", "\n", "1", "!"]) for _ in range(20_000))
    assert TokenCounter(PATH).count([text, "", text[7:]]).tolist() == library([text, "", text[7:]])


def test_rows_of_all_kinds(spark, library):
    rows = [(1, "two words", "x"), (1, "two words", "y"), (2, None, "z"), (None, "abé", None), (3, "", "n"), (4, "w " * 513, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3)
    got = sorted(map(tuple, count_tokens(docs).collect()), key=str)
    sizes = library([text or "" for _, text, _ in rows])
    expected = [(key, len((text or "").encode()), n, n > 512) for (key, text, _), n in zip(rows, sizes)]
    assert got == sorted(expected, key=str)
    assert count_tokens(docs.limit(0)).count() == 0


def test_whole_table_against_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in count_tokens(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    sizes = library([r.text or "" for r in rows])
    assert got == {r.doc_id: (len((r.text or "").encode()), n) for r, n in zip(rows, sizes)}
