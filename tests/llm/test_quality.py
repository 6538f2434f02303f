import numpy as np
import pyarrow as pa
from llm_data import make_docs, prose
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.text_hash import mix, word_slices

LABELS = "doc_id long, quality int, toxic int"
DATA = "/root/testdata/sf0.1"


def junk(seed):
    return " ".join(w + "$$$" for w in prose(seed).split())


def case(spark):
    texts = [junk(i) if i % 3 == 0 else prose(i) for i in range(240)]
    labels = [(i, int(i % 3 != 0), 0) for i in range(200)] + [(5, None, 0), (9999, 1, 0)]
    return make_docs(spark, texts + [None, "", prose(1, 50_000)]), spark.createDataFrame(labels, LABELS)


def test_unlabelled_texts_are_told_apart(spark):
    docs, labels = case(spark)
    got = {r.doc_id: r for r in quality.score_documents(docs, labels).collect()}
    assert len(got) == 243 and all(0 <= r.score <= 1 for r in got.values())
    assert all(got[i].predicted == int(i % 3 != 0) for i in range(240))
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[240].score == got[241].score
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.predicted}


def test_columns_with_the_names_of_working_columns(spark):
    docs, labels = case(spark)
    named = docs.withColumn("__score", F.lit("mine")).withColumn("__id", F.lit("too")).withColumn("good", F.lit(1))
    kept = quality.keep_good(named, labels)
    assert kept.columns == named.columns
    assert {r["__score"] for r in kept.collect()} == {"mine"}


def naive_features(text):
    """The set of a text's features by plain loops over its words."""
    words = next(word_slices(pa.array([text])))
    n, out = len(words.hash), set()
    mask = (1 << 64) - 1

    def mixed(x):
        return int(mix(np.array([x & mask], dtype=np.uint64))[0])

    shapes = []
    for k in range(n):
        raw = words.data[words.start[k]:words.end[k]]
        kinds = [int(quality._KIND[b]) for b in raw]
        shape = 0
        for kind in kinds:
            shape |= kind
        again = int(k > 0 and words.hash[k] == words.hash[k - 1])
        last = int(raw[-1]) if kinds[-1] == 8 else 0
        shapes.append(shape | kinds[0] << 5 | min(len(raw), 24) // 4 << 10 | again << 13 | last << 14)
    for values, sizes, seed in (([int(h) for h in words.hash], (1, 2), 0), (shapes, (1, 2, 3), 10)):
        for size in sizes:
            for k in range(n - size + 1):
                total = seed + size
                for v in values[k:k + size]:
                    total = mixed(total + v)
                out.add(total % quality.DIM)
    return sorted(out)


def test_scores_equal_plain_loops(spark):
    """The query's scores against the model applied text by text, feature by feature."""
    docs, labels = case(spark)
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score_documents(docs, labels).collect()}
    for r in docs.where("doc_id % 11 = 0 AND doc_id < 240 OR doc_id IN (240, 241)").collect():
        dot = norm = 0.0
        for f in naive_features(r.text or ""):
            dot += float(model.weight[f])
            norm += float(model.square[f])
        margin = (dot / norm**0.5 if norm else 0.0) + model.bias
        want = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30)))
        assert abs(got[r.doc_id] - want) < 1e-6


def test_held_out_labels_are_not_used(spark):
    docs, labels = case(spark)
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = quality.score_documents(docs, labels).orderBy("doc_id").collect()
    assert a == quality.score_documents(docs, flipped).orderBy("doc_id").collect()
    assert any(r.held_out for r in a)


def test_few_labels(spark):
    docs, labels = case(spark)
    for some, low, high in ((labels.limit(0), 0.5, 0.5), (labels.where("quality = 1"), 0.9, 1), (labels.where("quality = 0"), 0, 0.1)):
        assert all(low <= r.score <= high for r in quality.score_documents(docs, some).collect())


def test_bounded_sample(spark):
    docs, labels = case(spark)
    ids = quality.training_ids(docs, labels, per_class=10)
    assert sorted(r["count"] for r in ids.groupBy("good").count().collect()) == [10, 10]


def test_descent_finds_the_optimum():
    """Against projected gradient ascent on the same dual problem."""
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(30)]
    values = [rng.normal(size=5) for _ in rows]
    y = np.where(rng.random(30) < 0.5, 1.0, -1.0)
    cost = np.full(30, 0.7)
    x = np.zeros((30, 13))
    for i, (r, v) in enumerate(zip(rows, values)):
        x[i, r], x[i, 12] = v, 1.0
    q = (x * y[:, None]) @ (x * y[:, None]).T
    alpha = np.zeros(30)
    for _ in range(20_000):
        alpha = np.clip(alpha - 0.02 * (q @ alpha - 1), 0, cost)
    best = 0.5 * alpha @ q @ alpha - alpha.sum()
    epochs, quality.EPOCHS = quality.EPOCHS, 300
    try:
        w, bias = quality.descend(rows, values, y, cost)
    finally:
        quality.EPOCHS = epochs
    margin = np.array([w[r] @ v + bias for r, v in zip(rows, values)])
    primal = 0.5 * (w @ w + bias**2) + (cost * np.maximum(0, 1 - y * margin)).sum()
    assert abs(primal + best) < 1e-3 * max(1, abs(best))


def test_indicators_are_sets_per_text():
    (w,) = word_slices(pa.array(["a a b", "a a b", "", "B$$ c"]))
    doc, feature = quality.indicators(w)
    sets = [set(feature[doc == d].tolist()) for d in range(4)]
    assert sets[0] == sets[1] and not sets[2] and sets[3] and len(doc) == sum(map(len, sets))


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_documents(docs, labels).where("held_out").join(labels, "doc_id")
    right, n = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert n > 500 and right >= 0.97
