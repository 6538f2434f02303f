"""Windows, distinct counts and rankings on live streams."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.timing import interval_text
from tidemark.operators import windows
from tidemark.operators.topn import top_n
from tidemark.operators.windows import END, START, Mergeable
from tidemark.sources.readers import event_table

NO_DELAY = timedelta(0)


def live_windowed(
    stream: DataFrame,
    ts: str,
    size: timedelta,
    aggs: Sequence[Mergeable],
    slide: timedelta | None = None,
    keys: Sequence[str] = (),
    delay: timedelta = NO_DELAY,
) -> DataFrame:
    return windows.windowed(event_table(stream, ts, delay), ts, size, aggs, slide, keys)


def live_extreme_row(
    stream: DataFrame,
    ts: str,
    size: timedelta,
    keys: Sequence[str],
    value: str,
    order: str,
    pick: str,
    columns: Sequence[str],
    delay: timedelta = NO_DELAY,
) -> DataFrame:
    marked = event_table(stream, ts, delay)
    return windows.extreme_row(marked, ts, size, keys, value, order, pick, columns)


def live_distinct_count(
    stream: DataFrame,
    ts: str,
    value: str,
    size: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = NO_DELAY,
    name: str = "uv",
) -> DataFrame:
    """Number of distinct values per window by two aggregates in one plan, given when a window closes.

    The first groups by window and value and hands a value on when its window is past; the second
    counts them. Equal values of a micro-batch are one row before the shuffle.
    """
    marked = event_table(stream, ts, delay)
    w = F.window(F.col(ts), interval_text(size), interval_text(slide or size))
    once = marked.groupBy(w, value).agg(F.count(F.lit(1)).alias("rows"))
    counts = once.groupBy("window").agg(F.count(value).alias(name))
    return counts.select(F.col("window.start").alias(START), F.col("window.end").alias(END), name)


def ranked_on_close(path: str, group: str, value: str, key: str, n: int = 5) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that ranks the windows which a micro-batch closes, each written once.

    In append mode all keys of a window come in the micro-batch that closes it. A batch that comes again
    writes its folder again.
    """

    def write(closed: DataFrame, batch_id: int) -> None:
        top_n(closed, group, value, key, n).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def processing_time(stream: DataFrame, name: str = "processed_at") -> DataFrame:
    """Add the wall-clock time at which a micro-batch is processed, to window on."""
    return stream.withColumn(name, F.current_timestamp())


def append_to(out: DataFrame, path: str) -> DataStreamWriter:
    """Write finished windows to a folder, each once."""
    return out.writeStream.outputMode("append").format("parquet").option("path", path)


def each_batch(out: DataFrame, write: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    return out.writeStream.outputMode(mode).foreachBatch(write)


def run_available(writer: DataStreamWriter, checkpoint: str) -> str:
    """Run a query over everything that has arrived and stop; gives the id of the run."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return str(query.runId)
