"""Language ID: held-out accuracy, whole texts, odd input."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, score string"
SF = "/root/testdata/sf0.01/documents.parquet"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SF)


@pytest.fixture(scope="module")
def model(docs):
    return li.fit(li.training_rows(docs), per_language=100)


def test_held_out_accuracy(docs, model):
    held = docs.join(li.training_rows(docs).select("doc_id"), "doc_id", "left_anti")
    rows = li.identify(held, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 150
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_machines_are_family_first(model):
    assert ("family:germanic", "family:romance") in model.pairs
    assert {("de", "en"), ("es", "fr")} <= set(model.pairs) and ("de", "fr") not in model.pairs


def test_odd_input(spark, frame, model):
    german = "Der die und ist nicht " * 3
    rows = [(1, None, "x", "a"), (2, "", None, "b"), (3, "123 !? 4", "x", "c"), (4, german, "x", "d"), (4, german, "x", "d"),
            (None, "²", "x", "e"), (5, german * 20_000, "x", "f")]
    out = li.identify(frame(rows, SCHEMA), model).collect()
    found = sorted((r.doc_id or 0, r.lang_pred, round(r.score, 3)) for r in out)
    assert [f[:2] for f in found if f[0] < 4] == [(0, "und"), (1, "und"), (2, "und"), (3, "und")]
    assert [f[1] for f in found if f[0] >= 4] == ["de"] * 3 and len({f for f in found if f[0] == 4}) == 1
    kept = li.keep_identified(frame(rows, SCHEMA), model)
    assert kept.columns == ["doc_id", "text", "lang", "score"] and {r.doc_id for r in kept.collect()} == {4, 5}


def test_empty_tables_and_single_languages(frame):
    empty = frame([], SCHEMA)
    assert li.fit(empty) is None and li.identify(empty, None).count() == 0
    some = frame([(1, "abc", None, ""), (2, None, "en", "")], SCHEMA)
    assert li.fit(some) is None
    assert {r.lang_pred for r in li.identify(some, None).collect()} == {"und"}
    single = frame([(1, "abc def", "xx", ""), (2, "ghi", None, "")], SCHEMA)
    out = li.identify(single, li.fit(single)).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("xx", 1.0)] * 2


def test_windows_agree_with_counts():
    texts = ["abc äß", "", "x", "Z" * 50, "the cat. " * 9]
    column = pa.array(texts)
    weights = np.random.default_rng(0).normal(size=(li.BUCKETS + 1, 2)).astype(np.float32)
    weights[-1] = 0
    counts = np.stack(li.count_features(column))
    expected = counts @ weights[:-1] / np.maximum(counts.sum(1), 1)[:, None]
    means, sizes = li.mean_weights(column, weights)
    assert np.allclose(means, expected, atol=1e-5) and (sizes == counts.sum(1)).all()
    data, ends = li._buffers(column)
    small = [g for _, grams in li._features(data, ends, window=7) for g in zip(*grams)]
    large = [g for _, grams in li._features(data, ends) for g in zip(*grams)]
    assert small == large
