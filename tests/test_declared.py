"""Sinks written to by name, and the key of a query's result."""

import pytest
from fixtures import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import topn
from tidemark.session import rocksdb, scratch_path
from tidemark.sinks.declared import Sinks
from tidemark.sinks.result_key import result_key
from tidemark.streaming import windows as live
from tidemark.streaming.ordered import arrivals


@pytest.fixture
def rows(spark):
    return spark.range(60).select(
        F.col("id"), (F.col("id") % 4).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("ts"))


def test_key_of_a_grouping(spark, rows):
    counts = rows.groupBy("k").agg(F.count("*").alias("cnt"))
    assert result_key(counts) == ["k"]
    assert result_key(counts.select("cnt", F.col("k").cast("string").alias("name")).where("cnt > 1").orderBy("cnt")) == ["name"]
    assert result_key(counts.select("cnt")) is None
    assert result_key(rows) is None
    assert result_key(rows.agg(F.count("*").alias("n"))) == []
    counts.createOrReplaceTempView("key_counts")
    assert result_key(spark.sql("SELECT k AS a, max(cnt) AS m FROM key_counts GROUP BY k")) == ["a"]


def test_key_of_windows_and_rankings(spark, rows):
    w = rows.groupBy(F.window("ts", "1 minute"), "k").agg(F.count("*").alias("cnt"))
    assert result_key(w.select(F.col("window.end").alias("window_end"), "k", "cnt")) == ["window_end", "k"]
    assert result_key(w.select("k", "cnt")) is None
    ranked = topn.top_n(w.select(F.col("window.end").alias("window_end"), "k", "cnt"), "window_end", "cnt", "k", 2)
    assert result_key(ranked) == ["window_end", "row_num"]
    by = Window.partitionBy("k").orderBy("id")
    assert result_key(rows.withColumn("r", F.row_number().over(by)).select("id", "k")) is None
    assert result_key(rows.join(w.select("k"), "k")) is None


def test_columns_and_types_are_checked(spark, rows):
    sinks = Sinks(spark)
    sinks.declare("s", "name long, n long", scratch_path(spark, "sink"), mode="upsert")
    good = rows.groupBy("k").agg(F.count("*").alias("cnt"))
    for bad in (good.select("k"), good.select(F.col("k").cast("string"), "cnt"), rows.select("id", "k")):
        with pytest.raises(ValueError):
            sinks.insert_into("s", bad)
    with pytest.raises(KeyError):
        sinks.insert_into("other", good)
    with pytest.raises(ValueError):
        sinks.declare("s", "a int", "p")
    sinks.insert_into("s", good)
    assert rows_of(sinks.read("s"), "name", "n") == [(k, 15) for k in range(4)]
    with pytest.raises(ValueError):  # another key
        sinks.insert_into("s", rows.groupBy("id").agg(F.max("k").alias("m")).select("m", "id"))


def test_later_inserts_replace_by_key_or_append(spark, rows):
    sinks = Sinks(spark)
    for mode in ("upsert", "append"):
        sinks.declare(mode, "k long, n long", scratch_path(spark, "sink"), mode=mode)
        for part in (rows.where("id < 20"), rows.where("k > 1")):
            sinks.insert_into(mode, part.groupBy("k").agg(F.count("*").alias("n")))
    assert rows_of(sinks.read("upsert"), "k", "n") == [(0, 5), (1, 5), (2, 15), (3, 15)]
    assert sinks.read("append").count() == 6


def test_a_stream_into_a_declared_sink(spark, rows):
    sinks, path = Sinks(spark), scratch_path(spark, "sink")
    sinks.declare("live", "k long, n long", path, mode="upsert")
    counts = arrivals(rows, ["id"], batch_rows=20).groupBy("k").agg(F.count("*").alias("n"))
    with rocksdb(spark):
        live.run_available(sinks.insert_into("live", counts, "update"), f"{path}-checkpoint")
    assert rows_of(sinks.read("live"), "k", "n") == [(k, 15) for k in range(4)]


def test_statements_of_a_database_sink(spark, rows, monkeypatch):
    """No database runs here: the key reaches the statement, and the rows their staging table."""
    from tidemark.sinks import jdbc

    seen = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.jdbc", lambda self, url, table, **more: seen.append((url, table)))
    monkeypatch.setattr(jdbc, "run_statement", lambda spark, url, properties, sql: seen.append(sql))
    sinks = Sinks(spark)
    sinks.declare("totals", "name long, n long", "jdbc:x:y", kind="jdbc", mode="upsert", user="u")
    sinks.insert_into("totals", rows.groupBy("k").agg(F.count("*").alias("cnt")))
    assert seen[0][0] == "jdbc:x:y" and "ON t.name = s.name" in seen[1] and "UPDATE SET n = s.n" in seen[1]
