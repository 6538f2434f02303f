"""The time that a stream has seen, written beside each row in the order of arrival.

Spark's own watermark moves between micro-batches, so results that depend on it change with the cut of
the input, and rows behind it are dropped before an operator sees them. A first query stamps each row
with the watermark that holds when it arrives: the largest event time that came earlier, in this
micro-batch or one before, minus the delay. A second query reads the stamped rows in the same order and
takes ``clock``, the watermark after the row, as its event time. It never runs back, so no row is late
there, and timers follow the stamps.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions.timing import epoch_millis, interval_text, millis
from tidemark.operators.lateness import WATERMARK, with_watermark_before
from tidemark.sinks.folders import is_complete, remove
from tidemark.streaming.ordered import ROW_GROUP

CLOCK = "clock"
NO_CLOCK = -62_135_596_800_000  # the year 1, for rows without a time before any other
#: From a stamped batch, the folders to write and the rows of each.
Parts = Callable[[DataFrame], dict[str, DataFrame]]


def stamp(
    path: str, ts: str, arrival: Sequence[str], delay: timedelta = timedelta(0), parts: Parts | None = None,
    rows_per_block: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the stamped rows, or ``parts`` of them, and the time seen so far.

    The time seen before a batch comes from the mark its predecessor left. A batch that is delivered
    again gives the same rows; folders that were complete are left as they are, so a query that reads
    them as a stream sees no row twice. A batch is one file per folder, which is taken whole. Marks
    before the last are removed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, target = batch.sparkSession, f"batch_id={batch_id}"
        if is_complete(spark, f"{path}/marks/{target}"):
            return
        seen = None
        if batch_id > 0:
            seen = spark.read.schema("seen_ms long").parquet(f"{path}/marks/batch_id={batch_id - 1}").first()[0]
        marked = with_watermark_before(batch, ts, arrival, delay, rows_per_block)
        if seen is not None:
            marked = marked.withColumn(WATERMARK, F.greatest(F.col(WATERMARK), F.lit(seen - millis(delay))))
        rows = marked.persist() if parts else marked
        try:
            for name, part in (parts(rows) if parts else {"stamped": rows}).items():
                if not is_complete(spark, f"{path}/{name}/{target}"):
                    part.coalesce(1).write.mode("overwrite").options(**ROW_GROUP).parquet(f"{path}/{name}/{target}")
            if not parts:  # rows that are written once are read back, which takes less than keeping them
                rows = spark.read.schema(marked.schema).parquet(f"{path}/stamped/{target}")
            top = rows.agg(F.greatest(F.max(epoch_millis(F.col(ts))), F.lit(seen).cast("long")).alias("seen_ms"))
            top.write.mode("overwrite").parquet(f"{path}/marks/{target}")
        finally:
            if parts:
                rows.unpersist()
        if batch_id > 1:
            remove(spark, f"{path}/marks/batch_id={batch_id - 2}")

    return write


def stamped_stream(rows: DataFrame, path: str, name: str = "stamped") -> DataFrame:
    """What ``stamp`` wrote, as a stream in the same batches; ``rows`` gives the schema before the stamp."""
    fields = [*rows.schema.fields, *([StructField(WATERMARK, LongType())] if name == "stamped" else [])]
    reader = rows.sparkSession.readStream.schema(StructType(fields)).option("maxFilesPerTrigger", 1)
    return reader.parquet(f"{path}/{name}")


def close(spark: SparkSession, rows: DataFrame, path: str, until_ms: int) -> None:
    """A last row that moves the clock to a time; its other columns are null, and operators skip it."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    last = spark.range(1).select(*nulls, F.lit(until_ms).cast("long").alias(WATERMARK))
    last.write.mode("overwrite").parquet(f"{path}/stamped/batch_id={2**31 - 1}")


def seen_ms(spark: SparkSession, path: str) -> int | None:
    """The largest event time seen by the batches so far."""
    return spark.read.parquet(f"{path}/marks").agg(F.max("seen_ms")).first()[0]


def clocked(stamped: DataFrame, ts: str, delay: timedelta = timedelta(0)) -> DataFrame:
    """Stamped rows with their clock as event time: the watermark after the row, in milliseconds.

    Rows may share a clock, and Spark drops rows at the watermark, so that trails by a millisecond.
    Spark's watermark begins at 1970, so times must lie after it.
    """
    after = F.greatest(F.col(WATERMARK), epoch_millis(F.col(ts)) - millis(delay), F.lit(NO_CLOCK))
    marked = stamped.withColumn(CLOCK, F.timestamp_millis(after))
    return marked.withWatermark(CLOCK, interval_text(timedelta(milliseconds=1)))
