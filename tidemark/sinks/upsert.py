"""Upsert of keyed rows, in a database table or in a folder.

A micro-batch may be delivered again after a failure, so both forms write the same result
when the same batch comes twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.folders import numbered, remove

BATCH, UPTO = "batch_id", "upto"
COMPACT_EVERY = 50


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; combined before the shuffle."""
    last = F.struct(*order) if len(order) > 1 else F.col(order[0])
    row = F.max_by(F.struct(*df.columns), last).alias("row")
    return df.groupBy(*keys).agg(row).select("row.*")


def upsert_folder(
    path: str, keys: Sequence[str], order: Sequence[str], compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the newest row per key.

    Each batch is written to its own folder and replaces it when it is delivered again. Every
    ``compact_every`` batches the rows so far are resolved into one table and the folders it
    holds are removed, so a reader never has more than that many folders to resolve.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = numbered(spark, f"{path}/tables", UPTO)
        if tables and batch_id <= tables[-1]:
            return  # delivered again after its rows went into a table
        latest_by_key(batch, keys, order).write.mode("overwrite").parquet(f"{path}/log/{BATCH}={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            resolved = _resolved(spark, path, keys, order)
            resolved.write.mode("overwrite").parquet(f"{path}/tables/{UPTO}={batch_id}")
            for done in numbered(spark, f"{path}/log", BATCH):
                if done <= batch_id:
                    remove(spark, f"{path}/log/{BATCH}={done}")
            for old in tables:
                remove(spark, f"{path}/tables/{UPTO}={old}")

    return write


def _resolved(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    tables = numbered(spark, f"{path}/tables", UPTO)
    upto = tables[-1] if tables else -1
    fresh = [n for n in numbered(spark, f"{path}/log", BATCH) if n > upto]
    parts = [spark.read.parquet(f"{path}/tables/{UPTO}={upto}").withColumn(BATCH, F.lit(upto))] if tables else []
    if fresh:
        folders = [f"{path}/log/{BATCH}={n}" for n in fresh]
        log = spark.read.option("basePath", f"{path}/log").parquet(*folders)
        parts.append(log.withColumn(BATCH, F.col(BATCH).cast("int")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return latest_by_key(rows, keys, [BATCH, *order]).drop(BATCH)


def read_upserted(
    spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The current rows of an upsert folder: of two rows with a key, the later batch wins."""
    return _resolved(spark, path, keys, order)
