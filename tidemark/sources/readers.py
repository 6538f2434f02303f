"""Bounded and unbounded inputs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timing import interval_text
from tidemark.schemas import struct


def text_lines_of(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def text_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def _every_field(rows: DataFrame) -> DataFrame:
    """The same rows, with all columns in use: Spark parses only fields that a query needs."""
    return rows.where(F.length(F.concat_ws("", *rows.columns)) >= 0)


def csv_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headerless delimited records by position; a bad record fails the job."""
    return _every_field(spark.read.schema(struct(schema)).option("mode", "FAILFAST").csv(path))


def csv_stream(
    spark: SparkSession, folder: str, schema: str, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(struct(schema)).option("mode", "FAILFAST")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _every_field(reader.csv(folder))


def rows_of(spark: SparkSession, rows: Iterable, schema: str) -> DataFrame:
    """Literal rows."""
    return spark.createDataFrame(list(rows), struct(schema))


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Unbounded lines from a TCP server that the user runs."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def csv_table(spark: SparkSession, name: str, path: str, schema: str) -> None:
    """Register delimited files as a table for SQL."""
    csv_records(spark, path, schema).createOrReplaceTempView(name)


def csv_stream_table(spark: SparkSession, name: str, folder: str, schema: str, files_per_trigger: int | None = None) -> None:
    """Register the delimited files that arrive in a folder as a live table: SQL over it gives a stream."""
    csv_stream(spark, folder, schema, files_per_trigger).createOrReplaceTempView(name)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A registered table; a stream if a live table has that name."""
    return spark.table(name)


def table_stream(
    spark: SparkSession, path: str, schema: str | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """A parquet table as a stream of its files, a bounded number of bytes at a time if wanted.

    The path is given as a pattern, because a stream takes a single file only in that form.
    """
    known = struct(schema) if schema else spark.read.parquet(path).schema
    reader = spark.readStream.schema(known)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def event_table(
    stream: DataFrame, ts: str, delay: timedelta, names: dict[str, str] | None = None
) -> DataFrame:
    """Name the columns of a stream and mark its event-time column.

    ``withWatermark`` takes only timestamps with a zone, so others are cast.
    """
    named = stream.withColumnsRenamed(names or {})
    return named.withColumn(ts, named[ts].cast("timestamp")).withWatermark(ts, interval_text(delay))


def view(df: DataFrame, name: str, columns: list[str] | None = None) -> None:
    """Name a table, and its columns if given, for SQL."""
    (df.toDF(*columns) if columns else df).createOrReplaceTempView(name)
