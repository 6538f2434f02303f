"""Quality of texts by naive Bayes support vectors.

A text is the set of its hashed n-grams: words and word pairs, and runs of one to three token
shapes (kinds of characters, length, whether a token repeats the one before). Each indicator is
scaled by the log of the ratio of its smoothed class frequencies, the vector is brought to unit
length, and a linear model with hinge loss is fitted by dual coordinate descent. A logistic
curve, fitted on a part of the sample that the descent did not see, turns margins into scores.

The fit takes at most ``PER_CLASS`` labelled documents of each class, chosen by a hash of the
id; labels are averaged per id. Scoring reads every whole text in Arrow batches and broadcasts
one vector of fixed size.

Defined cases: a null or empty text has no n-gram and gets the score of the bias alone; null
labels are no labels; labels of unknown ids are ignored; with one class only all scores are that
class, without labels 0.5; repeated rows are scored each; null ids are scored and never learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import free_names
from tidemark.llm.scratch import durable
from tidemark.llm.text_hash import U, Words, mix, word_slices

DIM = 1 << 18
PER_CLASS = 2500
FOLDS = 5
ACCEPT = 0.3
SMOOTHING = 1.0
PENALTY = 1.0
EPOCHS = 12
HELD_BACK = 5  # every fifth sampled text fits the logistic curve
_KIND = np.full(256, 8, dtype=np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 1, 2, 4
_KIND[0x80:], _KIND[0xC0:] = 0, 16


def _runs(values: np.ndarray, doc: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(0, len(values) - size + 1)
    total = np.full(n, seed, dtype=U)
    for k in range(size):
        total = mix(total + values[k : k + n])
    inside = doc[:n] == doc[size - 1 : size - 1 + n] if n else np.zeros(0, bool)
    return total[inside], doc[:n][inside]


def indicators(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, feature) pairs of a slice of texts, sorted by text."""
    doc = words.text_of_word()
    if len(doc) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[words.data]
    shape = np.bitwise_or.reduceat(kind, words.start).astype(U)
    length = np.minimum(words.end - words.start, 24) // 4
    again = np.zeros(len(doc), dtype=U)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (doc[1:] == doc[:-1])
    last = words.data[words.end - 1].astype(U) * (kind[words.end - 1] == 8)
    first = kind[words.start].astype(U)
    shape = shape | first << U(5) | length.astype(U) << U(10) | again << U(13) | last << U(14)
    parts = [_runs(words.hash, doc, k, k) for k in (1, 2)] + [_runs(shape, doc, k, 10 + k) for k in (1, 2, 3)]
    keys = np.concatenate([d * DIM + (h % U(DIM)).astype(np.int64) for h, d in parts])
    keys = np.unique(keys)
    return keys // DIM, keys % DIM


@dataclass
class Model:
    """Weights with the log-count ratios folded in, the squared ratios, and the curve."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    shift: float

    def score(self, texts: pa.Array) -> np.ndarray:
        out = []
        for words in word_slices(texts):
            doc, feature = indicators(words)
            dot = np.bincount(doc, self.weight[feature], minlength=words.n_texts)
            norm = np.sqrt(np.bincount(doc, self.square[feature], minlength=words.n_texts))
            out.append(dot / np.where(norm > 0, norm, 1.0))
        margin = np.concatenate(out) + self.bias if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30)))


def _constant(score: float) -> Model:
    shift = float(np.log(score / (1 - score)))
    zero = np.zeros(DIM, np.float32)
    return Model(zero, zero, 0.0, 0.0, shift)


def descend(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: np.ndarray, seed: int = 1):
    """Weights and bias of the hinge-loss model by dual coordinate descent."""
    w, bias = np.zeros(DIM), 0.0
    alpha = np.zeros(len(rows))
    size = np.array([(v @ v) + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / size[i], 0.0), cost[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
    return w, bias


def _curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, with smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    at = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, x.T @ (p - target))
        at -= np.clip(move, -2, 2)
    return float(max(at[0], 1e-3)), float(at[1])


def fit_sample(rows: list[np.ndarray], good: np.ndarray) -> Model:
    """The model of sampled feature sets; ``good`` marks those of label 1."""
    if len(rows) == 0:
        return _constant(0.5)
    if good.all() or not good.any():
        return _constant(0.999 if good.all() else 0.001)
    seen = np.array([i % HELD_BACK != 0 for i in range(len(rows))])
    if len({*good[seen]}) < 2 or len({*good[~seen]}) < 2:
        seen[:] = True
    held = ~seen if not seen.all() else seen
    counts = np.zeros((2, DIM))
    for i in np.flatnonzero(seen):
        counts[int(good[i]), rows[i]] += 1
    p = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    ratio = np.log(p[1] / p[0])
    values = []
    for row in rows:
        v = ratio[row]
        norm = np.sqrt(v @ v)
        values.append(v / norm if norm > 0 else v)
    at = np.flatnonzero(seen)
    share = good[at].mean()
    cost = PENALTY * np.where(good[at], 0.5 / share, 0.5 / (1 - share))
    w, bias = descend([rows[i] for i in at], [values[i] for i in at], np.where(good[at], 1.0, -1.0), cost)
    margin = np.array([w[rows[i]] @ values[i] + bias for i in np.flatnonzero(held)])
    slope, shift = _curve(margin, good[held])
    return Model((w * ratio).astype(np.float32), (ratio**2).astype(np.float32), bias, slope, shift)


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def training_ids(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """(__id, good): at most ``per_class`` labelled ids of each class, outside the held-out fold."""
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    here = docs.select("doc_id").distinct().join(known.where(~held_out(F.col("doc_id"))), "doc_id")
    here = durable(here.withColumn("__h", F.xxhash64("doc_id")))
    # A first cut at a hash value leaves about twice as many as are wanted, so that a large class
    # is not ranked in one task.
    sizes = {r.good: r["count"] for r in here.groupBy("good").count().collect()}
    low = [F.when(F.col("good") == g, -(2**63) + min(2**64 - 1, 2**64 * 2 * per_class // n)) for g, n in sizes.items()]
    few = here.where(F.col("__h") <= F.coalesce(*low)) if low else here
    order = Window.partitionBy("good").orderBy("__h", "doc_id")
    ranked = few.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= per_class)
    return ranked.select(F.col("doc_id").alias("__id"), "good")


def _feature_rows(batches):
    for batch in batches:
        rows: list[bytes] = []
        for words in word_slices(batch.column(0)):
            doc, feature = indicators(words)
            cut = np.searchsorted(doc, np.arange(words.n_texts + 1))
            rows += [feature[cut[d] : cut[d + 1]].astype(np.int32).tobytes() for d in range(words.n_texts)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), *batch.columns[1:]], ["features", "good", "id"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Sample, read the features of the sampled texts and fit; the sample bounds what the driver gets."""
    ids = F.broadcast(training_ids(docs, labels, per_class))  # two times per_class rows at most
    sample = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("__id"))
    read = sample.select("text", "good", F.col("__id").cast("long")).mapInArrow(
        _feature_rows, "features binary, good boolean, id long")
    # Of rows that repeat an id one text is learned, so the driver gets two times per_class rows at most.
    found: pd.DataFrame = read.groupBy("id", "good").agg(F.min("features").alias("features")).toPandas()
    found = found.sort_values(["features"], kind="stable")
    rows = [np.frombuffer(f, np.int32) for f in found["features"]]
    order = np.random.default_rng(7).permutation(len(rows))
    good = found["good"].to_numpy(dtype=bool)
    return fit_sample([rows[i] for i in order], good[order])


def scores(docs: DataFrame, model: Model) -> Column:
    """The score of the text column, for the documents' own session."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(text), pa.float64())

    return score(F.col("text"))


def score_documents(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, per_class)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), scores(docs, model).alias("score")).withColumn(
        "predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """The documents predicted good, with all their columns."""
    model = fit(docs, labels, per_class)
    (score,) = free_names(docs, "score")
    return docs.withColumn(score, scores(docs, model)).where(F.col(score) >= ACCEPT).drop(score)
