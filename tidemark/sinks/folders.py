"""Folders of micro-batch results, looked at through the file system of the cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write into the folder was committed."""
    store, at = _path(spark, f"{path}/_SUCCESS")
    return store.exists(at)


def numbered(spark: SparkSession, path: str, label: str) -> list[int]:
    """The numbers of the complete folders ``label=number`` below a path, rising."""
    store, at = _path(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(at)] if store.exists(at) else []
    found = [int(n.removeprefix(f"{label}=")) for n in names if n.startswith(f"{label}=")]
    return sorted(n for n in found if is_complete(spark, f"{path}/{label}={n}"))


def remove(spark: SparkSession, path: str) -> None:
    store, at = _path(spark, path)
    store.delete(at, True)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme and store that the cluster gives to paths without them."""
    store, at = _path(spark, path)
    return store.makeQualified(at).toString()


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark wrote into a folder, in the order of their names."""
    store, at = _path(spark, path)
    found = [s.getPath() for s in store.listStatus(at)]
    return [p.toString() for p in sorted(found, key=lambda p: p.getName()) if not p.getName().startswith(("_", "."))]


def set_time(spark: SparkSession, path: str, millis: int) -> None:
    """Give a file a modification time, by which a file stream orders it."""
    store, at = _path(spark, path)
    store.setTimes(at, millis, -1)
