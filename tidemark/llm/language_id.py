"""Language identification in two steps: the family first, then the language within it.

Both steps are one-versus-one linear support vector machines on hashed byte
1- to 3-grams of the letters.  A linear machine over relative n-gram
frequencies is a mean of weights over positions, so whole texts of any
length are scored in one pass over fixed windows of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import documents, fold, slices

# Language codes by family.  A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ur", "ne"),
    "turkic": ("tr", "az", "kk", "uz"),
}
UNDETERMINED = "und"
BUCKETS = 1 << 13
_SPACE, _BASE = 0, 155
_LETTER = regex.compile(r"\p{L}")
# Letters a-z become 1-26, other ASCII a gap, bytes above 127 stay apart.
_CODE = np.zeros(256, np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[128:] = np.arange(27, 155)


def family_of(language: str) -> str:
    return next((f for f, members in FAMILIES.items() if language in members), language)


def _bucket(gram: np.ndarray) -> np.ndarray:
    """The top 13 bits of a multiplicative hash."""
    return ((gram.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def _features(data: np.ndarray, ends: np.ndarray, window: int = 1 << 20) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Windows of bytes: the first position and the feature of each position for 1-, 2- and 3-grams.

    An n-gram that would leave its text, or is only a gap, gets the feature ``BUCKETS``, whose weight is 0.
    """
    for a in range(0, len(data), window):
        b = min(a + window, len(data))
        code = np.full(b - a + 2, _SPACE, np.int64)
        piece = data[a : min(b + 2, len(data))]
        code[: len(piece)] = _CODE[piece]
        one, two, three = code[:-2], code[1:-1], code[2:]
        pair = one * _BASE + two
        triple = pair * _BASE + three
        grams = [one, _bucket(pair), _bucket(triple + 7919)]
        last = ends[np.searchsorted(ends, a, side="right") : np.searchsorted(ends, b + 1, side="right") + 1]
        for n, gram in enumerate(grams):
            gram[(one == _SPACE) if n == 0 else (pair == 0) if n == 1 else (triple == 0)] = BUCKETS
            for k in range(1, n + 1):
                cut = last - k
                gram[cut[(cut >= a) & (cut < b)] - a] = BUCKETS
        yield a, grams


def _buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch and the position where each ends."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def mean_weights(column: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the mean of ``weights`` (features, machines) over its n-grams, and its number of n-grams."""
    data, ends = _buffers(column)
    sums = np.zeros((len(ends), weights.shape[1]))
    sizes = np.zeros(len(ends))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    filled = np.flatnonzero(ends > starts)
    for a, grams in _features(data, ends):
        n = len(grams[0])
        inside = filled[(starts[filled] < a + n) & (ends[filled] > a)]
        cuts = np.maximum(starts[inside] - a, 0)
        total = weights[grams[0]] + weights[grams[1]] + weights[grams[2]]
        valid = sum((g != BUCKETS).astype(np.float32) for g in grams)
        sums[inside] += np.add.reduceat(total, cuts, axis=0)
        sizes[inside] += np.add.reduceat(valid, cuts)
    return sums / np.maximum(sizes, 1)[:, None], sizes


def count_features(column: pa.Array) -> list[np.ndarray]:
    """Per text: counts of all features, for fitting."""
    data, ends = _buffers(column)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    out = []
    for s, e in zip(starts, ends):
        counts = np.zeros(BUCKETS + 1, np.int64)
        for _, grams in _features(data[s:e], np.asarray([e - s])):
            for gram in grams:
                counts += np.bincount(gram, minlength=BUCKETS + 1)
        out.append(counts[:BUCKETS])
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 20, seed: int = 0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by dual coordinate descent."""
    rng = np.random.default_rng(seed)
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1], np.float32)
    square = np.einsum("ij,ij->i", x, x) + 0.5 / cost
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            gradient = y[i] * float(x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                w += np.float32((new - alpha[i]) * y[i]) * x[i]
                alpha[i] = new
    return w


@dataclass
class LanguageModel:
    """Families, languages and one machine per pair of either; weights are one column per machine."""

    languages: list[str]
    families: list[str]
    pairs: list[tuple[str, str]] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS + 1, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def _winner(self, names: list[str], margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the name with most duels won (ties: largest margin sum) and its certainty."""
        rows = np.arange(len(margins))
        if len(names) == 1:
            return np.zeros(len(margins), int), np.ones(len(margins))
        duel = np.zeros((len(margins), len(names), len(names)))
        for k, (p, q) in enumerate(self.pairs):
            if p in names and q in names:
                i, j = names.index(p), names.index(q)
                duel[:, i, j], duel[:, j, i] = margins[:, k], -margins[:, k]
        votes = (duel > 0).sum(2) + np.tanh(duel.sum(2)) / 4
        best = votes.argmax(1)
        own = duel[rows, best]
        own[rows, best] = np.inf
        return best, 1 / (1 + np.exp(-2 * own.min(1)))

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 where it is null or has no letter."""
        means, sizes = mean_weights(column, self.weights)
        margins = means + self.bias
        family, certainty = self._winner([f"family:{f}" for f in self.families], margins)
        out: list[str] = [UNDETERMINED] * len(margins)
        score = np.zeros(len(margins))
        letters = np.asarray([bool(n) and (_LETTER.search(t) is not None) for n, t in zip(sizes, column.to_pylist())], bool)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero((family == f) & letters)
            members = [x for x in self.languages if family_of(x) == name]
            best, within = self._winner(members, margins[rows])
            score[rows] = certainty[rows] * within
            for r, b in zip(rows, best):
                out[r] = members[b]
        return out, np.clip(score, 0, 1)


def fit(docs: DataFrame, label: str = "lang", per_language: int = 300) -> LanguageModel | None:
    """Fit on labelled rows: at most ``per_language`` documents of each language, whole texts.

    The sample is the rows with the smallest hash of their id, the same at every size.  Null and empty
    texts and null labels are left out; without any labelled text there is no model (None).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"), F.col("text"))
    rows = rows.where(F.col("label").isNotNull() & (F.length("text") > 0))
    # The choice reads no text.  It is made among parts of each language first, so that no task gets candidates from all.
    key = rows.select("doc_id", "label", F.xxhash64("doc_id").alias("key")).distinct()
    key = key.withColumn("part", F.pmod("key", F.lit(512)))
    for group in (("label", "part"), ("label",)):
        order = Window.partitionBy(*group).orderBy("key", "doc_id")
        key = key.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    chosen = key
    # per_language ids for each language.
    sample = rows.join(F.broadcast(chosen.select("doc_id", "label")), ["doc_id", "label"], "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            counts = count_features(batch.column("text"))
            used = [np.flatnonzero(c) for c in counts]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([u.astype(np.int16) for u in used], pa.list_(pa.int16())),
                    pa.array([c[u].astype(np.int32) for c, u in zip(counts, used)], pa.list_(pa.int32())),
                ],
                names=["doc_id", "label", "features", "counts"],
            )

    table = sample.mapInArrow(count, "doc_id long, label string, features array<short>, counts array<int>").toArrow()
    if not table.num_rows:
        return None
    table = table.sort_by([("label", "ascending"), ("doc_id", "ascending")])
    labels = table["label"].to_pylist()
    x = np.zeros((table.num_rows, BUCKETS + 1), np.float32)
    features, counts = table["features"].combine_chunks(), table["counts"].combine_chunks()
    at = features.offsets.to_numpy()
    for i in range(table.num_rows):
        n = counts.values[at[i] : at[i + 1]].to_numpy()
        x[i, features.values[at[i] : at[i + 1]].to_numpy()] = n / max(n.sum(), 1)
    scale = 1 / np.sqrt(x.mean(0) + 1e-5)
    x *= scale
    x[:, BUCKETS] = 1  # the bias
    languages = sorted(set(labels))
    families = sorted({family_of(f) for f in languages})
    groups = [("family:", [family_of(v) for v in labels], families)]
    groups += [("", labels, [v for v in languages if family_of(v) == f]) for f in families]
    model, columns = LanguageModel(languages, families), []
    for prefix, names, members in groups:
        for p, q in combinations(members, 2):
            rows_ = [i for i, v in enumerate(names) if v in (p, q)]
            columns.append(fit_svm(x[rows_], np.asarray([1.0 if names[i] == p else -1.0 for i in rows_])))
            model.pairs.append((prefix + p, prefix + q))
    if columns:
        w = np.stack(columns, 1)
        model.bias = w[BUCKETS].astype(float)
        model.weights = np.concatenate((w[:BUCKETS] * scale[:BUCKETS, None], np.zeros((1, w.shape[1])))).astype(np.float32)
    return model


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, lang_pred, score`` for every row.

    The language is ``und`` with score 0 where the text is null or has no letter, and everywhere without a model.
    Repeated rows are answered each; other columns are neither read nor returned; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in slices(batches, "text"):
            names, score = known.predict(batch.column("text")) if known else ([UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return documents(docs).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def training_rows(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """Rows that may be learned from: all but one fold of the ids."""
    return docs.where(fold("doc_id", parts) != held)


def keep_identified(docs: DataFrame, model: LanguageModel | None, min_score: float = 0.25) -> DataFrame:
    """The documents whose language is found with ``min_score`` or more, in all their columns; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            if sent.value is None:
                continue
            names, score = sent.value.predict(batch.column("text").fill_null(""))
            yield batch.filter(pa.array((np.asarray(names, object) != UNDETERMINED) & (score >= min_score)))

    return docs.mapInArrow(run, docs.schema)
