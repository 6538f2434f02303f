"""The registered live queries over several micro-batches of a table whose files are in no order."""

import shutil

import pyarrow.parquet as pq
import pytest
from compare import check, connect
from pyspark.sql import functions as F

from tidemark.plans import ORACLE, QUERIES
from tidemark.sinks.folders import data_files
from tidemark.streaming import ordered
from tidemark.streaming import windows as live

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
LIVE = sorted(n for n in QUERIES if n.startswith("stream_"))


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("shuffled"))
    for data in (SMALL, LARGER):
        for name, key in (("events", "event_id"), ("orders", "o_orderkey")):
            rows = spark.read.parquet(f"{data}/{name}.parquet")
            rows.repartition(3, F.xxhash64(key)).write.parquet(f"{root}{data}/{name}.parquet")
    yield root
    shutil.rmtree(root)


@pytest.mark.parametrize("name", LIVE)
def test_batches_of_a_shuffled_table(spark, shuffled, monkeypatch, name):
    data, rows = (LARGER, 4000) if name == "stream_sustained_rise_alert" else (SMALL, 300)  # alerts are rare
    monkeypatch.setattr("tidemark.plans.live.BATCH_BYTES", 1)
    monkeypatch.setattr(ordered, "BATCH_ROWS", rows)
    check(QUERIES[name](spark, f"{shuffled}{data}"), connect(data), ORACLE[name])


@pytest.mark.parametrize("name, label", [("count_window_5_2", "count-window"), ("sustained_rise_alert", "rises")])
def test_state_has_few_partitions(spark, tmp_path, monkeypatch, name, label):
    """Each one opens a store and a worker in each micro-batch; Spark's default is 200."""
    partitions = "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    monkeypatch.setattr("tidemark.plans.live.scratch_path", lambda spark, label: str(tmp_path / label))
    spark.conf.set(partitions, "200")
    try:
        QUERIES[f"stream_{name}"](spark, SMALL)
        assert spark.conf.get(partitions) == "200"
    finally:
        spark.conf.set(partitions, before)
    told = (tmp_path / label / "checkpoint" / "offsets" / "0").read_text()
    assert f'"{partitions}":"{max(16, 2 * spark.sparkContext.defaultParallelism)}"' in told


def test_files_are_bounded_and_taken_in_order(spark, tmp_path):
    rows = spark.range(1000).select("id", F.xxhash64("id").alias("at")).repartition(5, "id")
    last = spark.createDataFrame([(-1, -(2**63))], "id long, at long")
    folder = ordered.arrival_files(rows, ["at"], last, batch_rows=200)
    names = data_files(spark, folder)
    assert max(spark.read.parquet(n).count() for n in names) <= 200
    seen = []

    def write(batch, batch_id):
        seen.append([r["at"] for r in batch.collect()])

    live.run_available(live.each_batch(ordered.file_stream(rows, folder), write), str(tmp_path / "checkpoint"))
    assert len(seen) == len(names) >= 6 and seen[-1] == [-(2**63)]
    assert all(max(a) < min(b) for a, b in zip(seen[:-1], seen[1:-1])) and sum(map(len, seen)) == 1001


def test_files_are_filled_and_read_by_more_than_one_task(spark):
    """A range a little above the bound gave a second file, and so a micro-batch, of few rows."""
    rows = spark.range(400_000).select("id", F.xxhash64("id").alias("at"))
    names = data_files(spark, ordered.arrival_files(rows, ["at"], batch_rows=100_000))
    assert len(names) <= 6
    wide = spark.range(1_200_000).select("id", *[F.xxhash64("id", F.lit(i)).alias(f"x{i}") for i in range(2)])
    name = data_files(spark, ordered.arrival_files(wide, ["id"]))[0]
    assert pq.ParquetFile(name.removeprefix("file:")).num_row_groups > 1


def test_a_query_is_started_once(spark, monkeypatch):
    """No feed loop: one start for a query, two where a first query stamps the rows."""
    from pyspark.sql.streaming import DataStreamWriter

    starts, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **b: starts.append(1) or start(self, *a, **b))
    monkeypatch.setattr(ordered, "BATCH_ROWS", 300)
    for name, n in (("sliding_count", 1), ("running_word_count", 1), ("window_firings", 2)):
        starts.clear()
        QUERIES[f"stream_{name}"](spark, SMALL)
        assert len(starts) == n
