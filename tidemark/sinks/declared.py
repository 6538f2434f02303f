"""Sinks that are declared by name, columns, types and kind, and written to by name.

``insert_into`` checks a query against the declaration and maps its columns by position. An upserting
sink takes its key from the query's plan. Rows go to a folder, or to a database table over JDBC.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.schemas import struct
from tidemark.sinks import jdbc
from tidemark.sinks.folders import is_complete, numbered
from tidemark.sinks.result_key import result_key
from tidemark.sinks.upsert import BATCH, UPTO, read_upserted, upsert_folder

Write = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class Sink:
    """``place`` is the path of a folder or the address of a database."""

    name: str
    schema: StructType
    kind: str
    mode: str
    place: str
    properties: dict[str, str] = field(default_factory=dict)

    def checked(self, df: DataFrame) -> DataFrame:
        """The rows under the declared names; types must be the declared ones, one by one."""
        have, want = [f.dataType for f in df.schema], [f.dataType for f in self.schema]
        if have != want:
            shown = [", ".join(t.simpleString() for t in types) for types in (have, want)]
            raise ValueError(f"sink {self.name!r} takes ({shown[1]}), the query gives ({shown[0]})")
        return df.toDF(*self.schema.names)

    def key_of(self, df: DataFrame) -> list[str]:
        """The declared names of the columns that tell the query's rows apart."""
        key = result_key(df)
        if not key:
            raise ValueError(f"sink {self.name!r} upserts, but the query has no key")
        return [self.schema.names[df.columns.index(k)] for k in key]

    def writer(self, df: DataFrame) -> Write:
        """A ``foreachBatch`` function for the rows of a query."""
        if self.mode == "append":
            if self.kind == "folder":
                return lambda batch, i: self.checked(batch).write.mode("overwrite").parquet(f"{self.place}/{BATCH}={i}")
            return lambda batch, i: jdbc.append_jdbc(self.checked(batch), self.place, self.name, self.properties)
        key = self.key_of(df)
        if self.kind == "folder":
            self._keep(df.sparkSession, key)
            write = upsert_folder(self.place, key, key)
        else:
            write = jdbc.upsert_jdbc(self.place, self.name, self.properties, key, key)
        return lambda batch, i: write(self.checked(batch), i)

    def kept_key(self, spark: SparkSession) -> list[str] | None:
        """The key that earlier queries had, kept beside the rows."""
        if not is_complete(spark, f"{self.place}/key"):
            return None
        return [r.value for r in spark.read.text(f"{self.place}/key").collect()]

    def _keep(self, spark: SparkSession, key: list[str]) -> None:
        before = self.kept_key(spark)
        if before is None:
            spark.createDataFrame([(k,) for k in key], "value string").coalesce(1).write.text(f"{self.place}/key")
        elif before != key:
            raise ValueError(f"sink {self.name!r} upserts by {before}, the query's key is {key}")

    def next_batch(self, spark: SparkSession) -> int:
        if self.kind != "folder":
            return 0
        log = f"{self.place}/log" if self.mode == "upsert" else self.place
        done = numbered(spark, log, BATCH) + numbered(spark, f"{self.place}/tables", UPTO)
        return max(done, default=-1) + 1


class Sinks:
    """The declared sinks of a session."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self._sinks: dict[str, Sink] = {}

    def declare(
        self, name: str, columns: str, place: str, kind: str = "folder", mode: str = "append", **properties: str
    ) -> None:
        if kind not in ("folder", "jdbc") or mode not in ("append", "upsert"):
            raise ValueError("kind is 'folder' or 'jdbc', mode is 'append' or 'upsert'")
        if name in self._sinks:
            raise ValueError(f"sink {name!r} is declared already")
        self._sinks[name] = Sink(name, struct(columns), kind, mode, place, properties)

    def __getitem__(self, name: str) -> Sink:
        if name not in self._sinks:
            raise KeyError(f"no sink is declared as {name!r}")
        return self._sinks[name]

    def insert_into(self, name: str, df: DataFrame, output_mode: str = "append"):
        """Write a batch query now; for a stream, give the writer that a query is started with."""
        sink = self[name]
        sink.checked(df)
        write = sink.writer(df)
        if df.isStreaming:
            return df.writeStream.outputMode(output_mode).foreachBatch(write)
        write(df, sink.next_batch(self.spark))

    def read(self, name: str) -> DataFrame:
        """The rows that a folder sink holds."""
        sink = self[name]
        if sink.mode == "append":
            return self.spark.read.schema(sink.schema).parquet(*[
                f"{sink.place}/{BATCH}={i}" for i in numbered(self.spark, sink.place, BATCH)])
        key = sink.kept_key(self.spark)
        return read_upserted(self.spark, sink.place, key, key)
