import hashlib
from fractions import Fraction

import pytest
from llm_data import DOCS, make_docs
from pyspark.sql import functions as F

from tidemark.llm import mixing


@pytest.mark.parametrize("weights", [
    {"a": 1}, {"a": 50, "b": 1, "c": 1, "d": 48}, mixing.WEIGHTS, {"a": 3, "b": 5, "c": 7, "d": 11, "e": 13},
    {f"s{i}": 1 + i * i % 17 for i in range(60)},
])
def test_less_than_one_block_of_deviation(weights):
    period, placed = mixing.slots_of(weights)
    total = sum(weights.values())
    assert sorted(t for slots in placed.values() for t in slots) == list(range(period))
    for source, slots in placed.items():
        share = Fraction(weights[source], total)
        for j, t in enumerate(slots):
            assert Fraction(j) / share < t + 1 and t < Fraction(j + 1) / share
        done = 0
        for t in range(period):
            done += t in set(slots)
            assert abs(done - share * (t + 1)) < 1


def test_bad_weights():
    for weights in ({}, {"a": 0}):
        with pytest.raises(ValueError):
            mixing.slots_of(weights)


def brute(rows, weights, block):
    """The schedule slot by slot: (doc_id, source, slot, offset)."""
    period, placed = mixing.slots_of({mixing.REST: 1, **weights})
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    rest = sorted((s for s in groups if s not in weights), key=lambda s: (s is not None, s or ""))
    out = []
    for source, mine in groups.items():
        mine.sort(key=lambda r: (r[0] is not None, hashlib.md5(str(r[0]).encode()).hexdigest() if r[0] is not None else "", r[0] or 0))
        slots = placed[source if source in weights else mixing.REST]
        for n, (doc_id, _) in enumerate(mine):
            b, share = n // block, len(slots)
            b = b if source in weights else b * len(rest) + rest.index(source)
            out.append((doc_id, source or mixing.REST, b // share * period + slots[b % share], n % block))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_docs", [20_000, 7])
def test_places(spark, monkeypatch, bucket_docs):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", bucket_docs)
    weights = {"big": 3, "mid": 2, "none of these": 4}
    rows = [(i, "big" if i % 3 == 0 else ["mid", "x", "y", None][i % 4]) for i in range(400)] + [(None, "big")]
    docs = spark.createDataFrame([(i, f"text {i}", "en", s, 1) for i, s in rows], DOCS)
    mixed = mixing.mix_sources(docs.withColumn("mix_slot", F.lit("clash")), weights, block_docs=5)
    got = [(r.doc_id, r.mix_source, r.mix_slot, r.mix_offset) for r in mixed.collect()]
    assert sorted(got, key=repr) == brute(rows, weights, 5)
    assert set(mixed.columns) == {*docs.columns, *mixing.RESULTS}
    assert len({g[2:] for g in got}) == len(rows)


def test_shares_hold_while_all_sources_last(spark):
    weights = {"src1": 6, "src2": 3, mixing.REST: 1}
    docs = make_docs(spark, [f"t{i}" for i in range(3000)]).where("source IS NOT NULL")
    mixed = mixing.mix_sources(docs, weights, block_docs=4)
    order = [r.mix_source if r.mix_source in weights else mixing.REST for r in mixed.orderBy("mix_slot", "mix_offset").collect()][:1600]
    for n in range(40, 1601, 40):
        for source, weight in weights.items():
            assert abs(order[:n].count(source) - n * weight / 10) < 4


def test_each_source_without_a_weight_has_its_own_share(spark):
    """Ten sources share a half: while all last, none is a block away from a twentieth."""
    rows = [(i, "big" if i % 2 else f"s{i // 2 % 10}") for i in range(4000)]
    docs = spark.createDataFrame([(i, f"text {i}", "en", s, 1) for i, s in rows], DOCS)
    mixed = mixing.mix_sources(docs, {"big": 1, mixing.REST: 1}, block_docs=4)
    order = [r.mix_source for r in mixed.orderBy("mix_slot", "mix_offset").collect()]
    for n in range(8, 4001, 8):
        for k in range(10):
            assert abs(order[:n].count(f"s{k}") - n / 20) < 4


def test_columns_with_the_names_of_working_columns(spark):
    docs = make_docs(spark, [f"t{i}" for i in range(50)])
    for name in ("row", "h", "n", "lane", "turn", "bucket", "its_source", "place", "start", "__g", "__n", "__h", "__LANE", "___turn"):
        docs = docs.withColumn(name, F.lit(name))
    mixed = mixing.mix_sources(docs, {"src1": 1})
    assert mixed.columns == [*docs.columns, *mixing.RESULTS]
    assert {(r.row, r.n, r["__g"]) for r in mixed.collect()} == {("row", "n", "__g")}


def test_very_long_texts_and_null_ids(spark):
    docs = make_docs(spark, [(None, "x " * 500_000), (None, "y"), (None, "y"), (3, "z")])
    got = mixing.mix_sources(docs, {"src1": 1}).collect()
    assert len({(r.mix_slot, r.mix_offset) for r in got}) == 4


def test_repeated_rows_are_all_kept(spark):
    docs = make_docs(spark, [(1, "a")] * 5 + [(1, "b")])
    got = mixing.mix_sources(docs, {"src1": 1}).orderBy("mix_offset").collect()
    assert [r.mix_offset for r in got] == list(range(6))


def test_plan_has_no_python_and_no_single_task(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mix_sources(docs, mixing.WEIGHTS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
