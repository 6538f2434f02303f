"""Splitting hot keys must not change any result."""

from datetime import timedelta

import pytest
from fixtures import rows_of, skewed
from pyspark.sql import functions as F

from tidemark.operators import keyed
from tidemark.operators.counts import sliding_count, tumbling_count
from tidemark.operators.scan import BLOCK, Running, cut, hot_keys

SPAN = timedelta(seconds=6)
CASES = {
    "running": lambda df, n: keyed.running_sum(df, "k", ["seq"], F.col("v"), rows_per_block=n).drop("ts"),
    "changelog": lambda df, n: keyed.changelog(df, "k", ["seq"], rows_per_block=n),
    "jump": lambda df, n: keyed.jump_alert(df, "k", "v", "ts", ["seq"], 5, rows_per_block=n),
    "rise": lambda df, n: keyed.sustained_rise_alert(
        df, "k", "v", "ts", "seq", SPAN, min_rises=2, rows_per_block=n),
    "rise_hold": lambda df, n: keyed.sustained_rise_alert(
        df, "k", "v", "ts", "seq", SPAN, min_rises=2, at_end="hold", rows_per_block=n),
    "tumbling": lambda df, n: tumbling_count(df, "k", ["seq"], 5, rows_per_block=n, s=F.sum("v")),
    "sliding": lambda df, n: sliding_count(df, "k", ["seq"], 5, 2, rows_per_block=n, s=F.sum("v")),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_split_equals_plain(spark, name):
    df = skewed(spark)
    plain = rows_of(CASES[name](df, None))
    assert plain
    assert rows_of(CASES[name](df, 40)) == plain


def test_measures_in_blocks(spark):
    df = skewed(spark, 200)
    values = {
        "low": Running("min", F.struct("v", "seq")),
        "high": Running("max", F.col("v"), with_current=False),
        "prev": Running("prev", F.when(F.col("v") > 5, F.col("v"))),
    }
    plain = rows_of(keyed.with_running(df, ["k"], ["seq"], values), "seq", "low.v", "high", "prev")
    split = keyed.with_running(df, ["k"], ["seq"], values, rows_per_block=25)
    assert rows_of(split, "seq", "low.v", "high", "prev") == plain


def test_blocks_hold_a_bounded_number_of_rows(spark):
    """Also where all rows have the same first order column."""
    df = skewed(spark).withColumn("day", F.lit(1))
    hot = hot_keys(df, ["k"], 40)
    assert ("hot",) in rows_of(hot.table) and hot.blocks > 3
    for order in (["seq"], ["day", "seq"]):
        blocked = cut(hot.part(df, "left_semi"), ["k", *order], hot.blocks)
        sizes = blocked.groupBy("k", BLOCK).count()
        assert sizes.agg(F.max("count")).first()[0] <= 80
        assert hot.part(df, "left_semi").count() == sizes.agg(F.sum("count")).first()[0]


def test_thousands_of_blocks(spark):
    df = spark.range(6000).selectExpr("id AS seq", "IF(id % 3 = 0, 'b', 'a') AS k", "1.0D AS v")
    got = keyed.running_sum(df, "k", ["seq"], rows_per_block=2)
    counts = got.groupBy("k").agg(F.count_distinct("cnt").alias("n"), F.max("cnt").alias("m"))
    assert rows_of(counts) == [("a", 4000, 4000), ("b", 2000, 2000)]


def test_null_keys_are_split_too(spark):
    df = skewed(spark).withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    plain = rows_of(keyed.running_sum(df, "k", ["seq"]), "seq", "cnt")
    assert rows_of(keyed.running_sum(df, "k", ["seq"], rows_per_block=30), "seq", "cnt") == plain


def test_small_keys_are_not_split(spark):
    assert hot_keys(skewed(spark), ["k"]) is None


def brute_rises(rows, span_ms, at_least):
    """Alerts by the rule, one key at a time."""
    keys = {}
    for r in rows:
        keys.setdefault(r.k, []).append(r)
    out = set()
    for k, seq in keys.items():
        seq.sort(key=lambda r: (r.ms, r.seq))
        states, run, start, ups = [], 0, seq[0].ms, 0
        for i, r in enumerate(seq):
            if i and r.v < seq[i - 1].v:
                run, start, ups = run + 1, r.ms, 0
            elif i and r.v > seq[i - 1].v:
                ups += 1
            states.append((r.ms, run, start, ups))
        for r, (_, run, start, _) in zip(seq, states):
            then = [s for s in states if s[0] <= r.ms + span_ms][-1]
            if then[1] == run and then[3] >= at_least:
                out.add((k, r.seq, r.ms + span_ms, start, then[3]))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rise_equals_brute_force(spark, seed):
    df = skewed(spark, 300, seed)
    got = keyed.sustained_rise_alert(df, "k", "v", "ts", "seq", SPAN, min_rises=2, rows_per_block=50)
    got = {tuple(r) for r in got.select("k", "seq", "timer_ms", "run_start_ms", "rises").collect()}
    want = brute_rises(df.collect(), 6000, 2)
    assert want and got == want
