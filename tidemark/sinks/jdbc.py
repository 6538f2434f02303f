"""Append to and upsert into a database table over JDBC.

Address and credentials come from the caller. The driver jar must be on the class path.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sinks.upsert import latest_by_key

# Column types of the result tables.
TOP_ITEMS_TYPES = "commodityId BIGINT, windowEnd TIMESTAMP, cnt BIGINT, row_num BIGINT"
TOP_URLS_TYPES = "url VARCHAR(100), windowEnd TIMESTAMP, cnt BIGINT, row_num BIGINT"
COUNT_TYPES = "id VARCHAR(50), cnt BIGINT"
SINK_NAMES = {"item_id": "commodityId", "window_end": "windowEnd"}


def append_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], types: str | None = None
) -> None:
    """Insert the rows; the table is made when it is missing, with the given column types."""
    writer = df.write.mode("append")
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.jdbc(url, table, properties=properties)


def merge_sql(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """One statement that updates the rows whose key is present and inserts the others."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    values = [c for c in columns if c not in keys]
    update = ", ".join(f"{c} = s.{c}" for c in values)
    matched = f" WHEN MATCHED THEN UPDATE SET {update}" if values else ""
    return (
        f"MERGE INTO {table} t USING {staging} s ON {match}{matched}"
        f" WHEN NOT MATCHED THEN INSERT ({', '.join(columns)})"
        f" VALUES ({', '.join(f's.{c}' for c in columns)})"
    )


def duplicate_key_sql(table: str, staging: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """The same for databases without MERGE, whose inserts can update on a duplicate key.

    ``keys`` must be a unique key of the table.
    """
    values = [c for c in columns if c not in keys] or list(keys)
    names = ", ".join(columns)
    update = ", ".join(f"{c} = VALUES({c})" for c in values)
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging} ON DUPLICATE KEY UPDATE {update}"


def as_sink_columns(ranked: DataFrame) -> DataFrame:
    """Ranked rows under the column names of the result tables."""
    return ranked.withColumnsRenamed(SINK_NAMES)


def run_statement(spark: SparkSession, url: str, properties: dict[str, str], sql: str) -> None:
    """Run one statement on a connection of the driver."""
    jvm = spark.sparkContext._jvm
    info = jvm.java.util.Properties()
    for name, value in properties.items():
        if name == "driver":
            jvm.java.lang.Class.forName(value)
        else:
            info.setProperty(name, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, info)
    try:
        statement = connection.createStatement()
        statement.executeUpdate(sql)
        statement.close()
    finally:
        connection.close()


def upsert_jdbc(
    url: str,
    table: str,
    properties: dict[str, str],
    keys: Sequence[str],
    order: Sequence[str],
    staging: str | None = None,
    merge: Callable[..., str] = merge_sql,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: the executors load a staging table, one statement merges it.

    ``merge`` writes the statement, for databases with another form of it. A repeated batch
    merges the same rows again and changes nothing. Each call has a staging table of its own.
    """
    side = staging or f"{table}_staging_{uuid.uuid4().hex[:12]}"

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_by_key(batch, keys, order)
        rows.write.mode("overwrite").option("truncate", True).jdbc(url, side, properties=properties)
        run_statement(batch.sparkSession, url, properties, merge(table, side, keys, batch.columns))

    return write
