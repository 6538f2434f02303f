import re

import pytest
from conftest import DATA
from llm_data import make_docs
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tidemark.llm import quality
from tidemark.llm.scratch import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows before each stage and after the last."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = [docs]
    for name, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, DATA), name)
        seen.append(docs)
    return [{r.doc_id: r for r in d.collect()} for d in seen], seen


def grams(text, pattern):
    w = re.findall(pattern, text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_order_of_stages():
    assert [n for n, _ in pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]


def test_columns(stages):
    frames = stages[1]
    assert all(f.columns == COLUMNS for f in frames[:-1])
    assert set(frames[-1].columns) == {*COLUMNS, "mix_source", "mix_slot", "mix_offset"}


def test_quality_follows_the_labels(spark, stages):
    before, after = stages[0][:2]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    known = labels.where(quality.held_out(F.col("doc_id"))).collect()
    right = sum((r.doc_id in after) == bool(r.quality) for r in known if r.doc_id in before)
    assert right >= 0.95 * len(known)


def test_exact_copies(stages):
    before, after = stages[0][1:3]
    first = {}
    for i, r in sorted(before.items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), i)
    assert set(after) == set(first.values())


def test_near_copies(stages):
    before, after = stages[0][2:4]
    sets = {i: grams(r.text, r"[^\x20\x09-\x0D]+") for i, r in before.items()}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    places = {}
    for i, s in sets.items():
        for g in s:
            places.setdefault(g, []).append(i)
    pairs = {(a, b) for p in places.values() for a in p for b in p if a < b}
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    assert set(after) == {i for i in sets if top(i) == i}


def test_benchmark_items(spark, stages):
    before, after = stages[0][3:5]
    items = [grams(r.text.lower(), r"[^\W_]+") for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = set()
    for i, r in before.items():
        have = grams((r.text or "").lower(), r"[^\W_]+")
        if any(len(x & have) >= 0.8 * len(x) for x in items):
            bad.add(i)
    assert bad and set(after) == set(before) - bad


def test_all_are_mixed(stages):
    before, after = stages[0][4:]
    assert set(before) == set(after)
    assert len({(r.mix_slot, r.mix_offset) for r in after.values()}) == len(after)


def test_run_gives_the_last_stage(spark, stages):
    got = {r.doc_id: r.mix_slot for r in pipeline.run(spark, DATA).collect()}
    assert got == {i: r.mix_slot for i, r in stages[0][-1].items()}


def test_odd_tables(spark, tmp_path):
    """Nulls, repeated rows and an empty table pass all stages."""
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{DATA}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    texts = [(None, None), (None, "a b"), (1, ""), (1, ""), (2, "x " * 5000), (2, "x " * 5000), (3, "é")]  # (None, None) equals (1, "")
    odd = make_docs(spark, texts)
    for n, docs in enumerate((odd, odd.limit(0))):
        out = f"{tmp_path}/in{n}"
        docs.write.parquet(f"{out}/documents.parquet")
        rows = spark.read.parquet(f"{out}/documents.parquet")
        for name, stage in pipeline.STAGES:
            rows = written(stage(spark, rows, str(tmp_path)), name)
        assert rows.count() == (0 if n else 4)
