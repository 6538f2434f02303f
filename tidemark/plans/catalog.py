"""Registry of the queries and of the SQL that states the same result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import first_number

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the item number found in their properties."""
    return table(spark, sf_dir, "events").withColumn("item_id", first_number(F.col("props")))


def own_name(label: str) -> str:
    """A view name that no view of the user has."""
    return f"{label}_{uuid.uuid4().hex}"


# SQL counterparts of ``events`` and of the windows that cover a row.
EV = """ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id FROM events)"""


def windows_sql(source: str, ts: str, size: str, slide: str, copies: int) -> str:
    """A relation with one row per row of the source and window it falls in."""
    start = f"time_bucket(INTERVAL '{slide}', {ts}, TIMESTAMP '1970-01-01') - r.i * INTERVAL '{slide}'"
    return f"""(SELECT s.*, {start} AS window_start, {start} + INTERVAL '{size}' AS window_end
  FROM {source} s, (SELECT unnest(range({copies})) AS i) r)"""
