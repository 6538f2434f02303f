"""Durable intermediate results in the shared folder of the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import scratch_path, written

__all__ = ["durable", "scratch_path", "written"]


def durable(df: DataFrame) -> DataFrame:
    """The rows behind a reliable checkpoint: lineage ends there and lost executors do no harm.

    The folder is the one the session names; ours is set only where none is (as in tests).
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(scratch_path(spark, "checkpoints"))
