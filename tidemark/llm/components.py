"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scratch import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the least of its component, for edges (a, b).

    Each round is two joins on node ids, cut off by a written table; minima are combined before the
    shuffle and written, so that Spark can split a node with many edges in the join. The number of rounds grows with the logarithm of the longest path.
    """
    at = written(edges.where("a <> b").distinct(), "edges")
    before = _state(at)
    while True:
        at = written(_small(_large(at)), "edges")
        now = _state(at)
        if now == before:
            return at.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
