"""Accumulators of the user's own, and the counter of a running stream."""

import pickle
import time

import pandas as pd
import pytest
from fixtures import rows_of
from pandas.core.groupby import DataFrameGroupBy
from pyspark.sql import functions as F

from tidemark.operators import accumulate as accumulators
from tidemark.operators.accumulate import LargestMean, accumulate
from tidemark.session import scratch_path
from tidemark.streaming import windows as live
from tidemark.streaming.counter import RowCounter
from tidemark.streaming.ordered import arrivals


def extremes():
    """Defined inside a function, so that workers need not import this file."""

    class Extremes:
        """Smallest and largest value and how many rows there were, as a text."""

        def create(self):
            return None

        def add(self, state, value, other):
            assert other == value * 2
            return (value, value, 1) if state is None else self.merge(state, (value, value, 1))

        def merge(self, a, b):
            return min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]

        def result(self, state):
            return f"{state[0]}-{state[1]}/{state[2]}"

    return Extremes()


@pytest.mark.parametrize("batch", [10000, 7])
def test_a_hot_key_and_odd_keys(spark, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = spark.range(3000).select(
            F.expr("CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 6 = 0 THEN concat('k', id % 10) END").alias("a"),
            (F.col("id") % 2).alias("b"), F.col("id").alias("v"), (F.col("id") * 2).alias("w")).repartition(6)
        got = accumulate(rows, ["a", "b"], ["v", "w"], extremes(), "told", "string")
        want = rows.groupBy("a", "b").agg(F.concat(F.min("v"), F.lit("-"), F.max("v"), F.lit("/"), F.count("*")).alias("told"))
        assert rows_of(got) == rows_of(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_largest_mean(spark):
    rows = spark.createDataFrame([(1, 4.0), (1, 8.0), (1, None), (1, 6.0), (2, None), (None, 3.0), (3, 5.0)], "k int, v double")
    got = accumulate(rows, ["k"], ["v"], LargestMean(2), "m", "double")
    assert set(map(tuple, got.collect())) == {(1, 7.0), (2, None), (None, 3.0), (3, 5.0)}
    assert accumulate(rows.limit(0), ["k"], ["v"], LargestMean(2), "m", "double").collect() == []


def test_a_batch_of_many_keys_makes_no_frame_per_key(monkeypatch):
    """A frame per key costs more than the rows of it, where nearly every row is a key of its own."""
    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = lambda self: 3

    monkeypatch.setattr(accumulators, "TaskContext", Task)
    monkeypatch.setattr(DataFrameGroupBy, "__iter__", lambda self: pytest.fail("a frame per key"))
    rows = pd.DataFrame({"k": [5.0, None, 4.0, 5.0, None], "v": [1.0, 2.0, 3.0, 4.0, None]})
    (got,) = accumulators._partial(["k"], ["v"], LargestMean(2))(iter([rows]))
    held = {None if pd.isna(k) else k: pickle.loads(state) for k, state in zip(got["k"], got["__state"])}
    assert held == {5.0: [4.0, 1.0], None: [2.0], 4.0: [3.0]} and set(got["__part"]) == {3}


def test_plan_merges_in_phases(spark):
    rows = spark.range(10).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("v"))
    plan = accumulate(rows, ["k"], ["v"], LargestMean(1), "m", "double")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") == 3 and plan.count("Exchange hashpartitioning") == 2


def test_counter_over_a_restart(spark):
    rows = spark.range(400)
    counter, path = RowCounter("seen"), scratch_path(spark, "counted")
    spark.streams.addListener(counter)
    try:
        out = counter.counted(arrivals(rows, ["id"], batch_rows=50))
        writer = live.append_to(out, f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
        first = writer.trigger(availableNow=True).start()
        while first.isActive and len(first.recentProgress) < 2:
            time.sleep(0.02)
        first.stop()
        assert counter.wait_for(str(first.runId))
        second = live.run_available(live.append_to(out, f"{path}/out"), f"{path}/checkpoint")
        assert counter.wait_for(second) and counter.total == 400
        assert len(counter.batches) >= 8
    finally:
        spark.streams.removeListener(counter)
