"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.folders import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PARTITIONS = "spark.sql.shuffle.partitions"
STORES_PER_CORE, LEAST_STORES = 2, 16


def build_session(app_name: str = "tidemark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster use the submitted one."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        STATE_STORE: ROCKSDB,
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return with_package(builder.getOrCreate())


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    A cluster whose executors lack that path gets the package with ``--py-files`` as usual.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)
    return spark


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep keyed state in RocksDB; the session's own choice comes back."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before) if before else spark.conf.unset(STATE_STORE)


@contextmanager
def few_stores(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in ``STORES_PER_CORE`` partitions a core at most.

    Each partition opens its state store and a Python worker in each micro-batch, which takes longer than
    the rows of a bounded micro-batch if there are many. The session's own choice comes back.
    """
    before = spark.conf.get(PARTITIONS)
    spark.conf.set(PARTITIONS, str(min(int(before), max(LEAST_STORES, STORES_PER_CORE * spark.sparkContext.defaultParallelism))))
    try:
        yield
    finally:
        spark.conf.set(PARTITIONS, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder of ``spark.checkpoint.dir``, or else below the warehouse.

    Both are resolved through the file system of the cluster, never as a folder of one machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _temporary:
        _temporary[-1].append(path)
    return path


_temporary: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside are removed at the end; what shall stay is written to a path from before."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            remove(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder, so that later passes do not compute them again."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
