"""The same questions asked of live streams.

A table reaches a query as a plain file stream in the order in which its rows arrived, written once, a
bounded number of rows per micro-batch (``streaming.ordered``); where that order does not matter, the
query reads the files of the table as they are, ``BATCH_BYTES`` at a time. Each query is started once and
ends when all files are read. A last row far ahead closes what a query gives only when a window closes.
Results must equal the SQL of the batch query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import first_number
from tidemark.functions.timing import millis
from tidemark.operators import keyed, windows
from tidemark.operators.aggregates import GROUP_COUNT_SQL as GROUP_COUNT
from tidemark.operators.aggregates import group_count
from tidemark.plans import batch as b
from tidemark.plans import windows as w
from tidemark.plans.catalog import own_name, query, table
from tidemark.schemas import BEHAVIOR
from tidemark.session import few_stores, rocksdb, scratch_path
from tidemark.sinks.upsert import read_upserted, upsert_folder
from tidemark.sources import parsers, readers
from tidemark.streaming import lateness, stamped, stateful
from tidemark.streaming import windows as live
from tidemark.streaming.counter import RowCounter
from tidemark.streaming.ordered import arrival_files, arrivals

BATCH_BYTES = 1 << 30
Order = Sequence[str | Column]


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return readers.table_stream(spark, f"{sf_dir}/{name}.parquet", bytes_per_trigger=BATCH_BYTES)


def _zoneless(df: DataFrame) -> DataFrame:
    """Streams carry timestamps with a zone; the tables have none."""
    for f in df.schema.fields:
        if f.dataType.simpleString() == "timestamp":
            df = df.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
    return df


def _run(out: DataFrame, write: Callable[[DataFrame, int], None], path: str, mode: str = "append") -> None:
    with rocksdb(out.sparkSession):
        live.run_available(live.each_batch(out, write, mode), f"{path}/checkpoint")


def _appended(out: DataFrame, label: str) -> DataFrame:
    """What an append-mode query writes."""
    spark, path = out.sparkSession, scratch_path(out.sparkSession, label)
    with rocksdb(spark), few_stores(spark):
        live.run_available(live.append_to(out, f"{path}/out"), f"{path}/checkpoint")
    return _zoneless(spark.read.schema(out.schema).parquet(f"{path}/out"))


def _upserted(out: DataFrame, label: str, key: list[str], order: list[str], mode: str = "update") -> DataFrame:
    """The rows that an upsert by key leaves."""
    spark, path = out.sparkSession, scratch_path(out.sparkSession, label)
    _run(out, upsert_folder(f"{path}/out", key, order), path, mode)
    return _zoneless(read_upserted(spark, f"{path}/out", key, order))


def _closing(rows: DataFrame, ts: str, wait: timedelta) -> DataFrame:
    """One row whose time lies so far ahead that all windows of the others close; the rest of it is null."""
    last = rows.agg(F.max(F.col(ts).cast("timestamp")).alias("last"))
    ahead = (F.col("last") + F.lit(wait)).cast(rows.schema[ts].dataType)
    return last.where("last IS NOT NULL").select(
        *[ahead.alias(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])


BY_TIME = ["ts", "event_id"]
WINDOW = ["window_start", "window_end"]


@query(w.SLIDING_SQL)
def stream_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    aggs = [windows.count_rows(), windows.first_of(F.col("ts"), F.col("event_id"), "first_ts")]
    out = live.live_windowed(arrivals(rows, BY_TIME), "ts", w.HOUR, aggs, w.TEN_MINUTES, ["event_type"], w.MONTH)
    return _upserted(out, "sliding", ["event_type", *WINDOW], ["cnt"])


@query(w.ROW_SQL.format(size="1 hour", direction="DESC"))
def stream_tumbling_max_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    out = live.live_extreme_row(
        arrivals(rows, BY_TIME), "ts", w.HOUR, ["event_type"], "value", "event_id", "max", ["event_id", "ts", "value"], w.MONTH)
    return _upserted(out, "max-row", ["event_type", *WINDOW], ["value"])


@query(w.UV_SQL)
def stream_uv_3h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two aggregates in one streaming plan."""
    rows = table(spark, sf_dir, "events").where(w.VIEW).select("ts", "user_id")
    stream = arrivals(rows, ["ts"], _closing(rows, "ts", 2 * w.THREE_HOURS))
    return _appended(live.live_distinct_count(stream, "ts", "user_id", w.THREE_HOURS, w.HOUR), "uv")


@query(w.HOT_ITEMS_SQL)
def stream_hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each window ranked in the micro-batch that closes it, and written once."""
    rows = table(spark, sf_dir, "events").where(w.VIEW).select("ts", first_number(F.col("props")).alias("item_id"))
    stream = arrivals(rows, ["ts"], _closing(rows, "ts", 2 * w.HOUR))
    counts = live.live_windowed(stream, "ts", w.HOUR, [windows.count_rows()], w.TEN_MINUTES, ["item_id"])
    path = scratch_path(spark, "hot-items")
    _run(counts.select("item_id", "window_end", "cnt"), live.ranked_on_close(f"{path}/out", "window_end", "cnt", "item_id"), path)
    return _zoneless(spark.read.parquet(f"{path}/out").drop("batch_id"))


@query(b.GROUP_COUNT_SQL)
def stream_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts in update mode, upserted by key."""
    counts = _stream(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("cnt"))
    return _upserted(counts, "counts", ["event_type"], ["cnt"])


EVENT_LINES = "event_id long, event_type string, value double"


def _live_table(spark: SparkSession, sf_dir: str) -> str:
    """The name of a live table over delimited files."""
    rows, name = table(spark, sf_dir, "events").select("event_id", "event_type", "value"), own_name("live_events")
    readers.csv_stream_table(spark, name, arrival_files(rows, ["event_id"], form="csv"), EVENT_LINES, 1)
    return name


@query(b.GROUP_COUNT_SQL)
def stream_group_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a live table of delimited files."""
    counts = spark.sql(GROUP_COUNT.format(key="event_type", view=_live_table(spark, sf_dir)))
    return _upserted(counts, "counts-sql", ["event_type"], ["cnt"])


@query("SELECT event_type, count(*) AS cnt FROM events WHERE value > 10 GROUP BY event_type")
def stream_named_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live table read by its name."""
    rows = readers.table(spark, _live_table(spark, sf_dir)).where("value > 10")
    return _upserted(group_count(rows, "event_type"), "counts-named", ["event_type"], ["cnt"])


@query("SELECT count(*) AS cnt FROM events")
def stream_accumulated_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted on their way through a running query, from what its micro-batches report."""
    counter, path = RowCounter(own_name("rows")), scratch_path(spark, "counted")
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    spark.streams.addListener(counter)
    try:
        out = counter.counted(arrivals(rows, ["event_id"]))
        run = live.run_available(live.append_to(out, f"{path}/out"), f"{path}/checkpoint")
        if not counter.wait_for(run):
            raise TimeoutError("the query's reports did not come")
    finally:
        spark.streams.removeListener(counter)
    return spark.createDataFrame([(counter.total,)], "cnt long")


@query(b.GROUP_COUNT_SQL)
def stream_wall_clock_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of processing time; which window a row falls in varies, the totals do not."""
    timed = live.processing_time(_stream(spark, sf_dir, "events").select("event_type"))
    out = live.live_windowed(timed, "processed_at", w.FIFTEEN, [windows.count_rows()], keys=["event_type"])
    kept = _upserted(out, "wall-clock", ["event_type", *WINDOW], ["cnt"])
    return kept.groupBy("event_type").agg(F.sum("cnt").alias("cnt"))


@query(f"""
WITH {w.EV}
SELECT event_type AS behavior, window_start, window_end, count(*) AS cnt
FROM {w.windows_sql("(SELECT event_type, date_trunc('second', ts) AS ts FROM ev)", "ts", "1 hour", "10 minutes", 6)}
GROUP BY event_type, window_start, window_end
""")
def stream_text_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited text files as a stream, parsed and counted per window."""
    seconds = F.substring_index("value", ",", -1).cast("long")
    lines = arrivals(b.behavior_lines(spark, sf_dir), [seconds], form="text")
    parsed = parsers.parse_delimited(lines, BEHAVIOR).select("behavior", F.timestamp_seconds("ts_s").alias("ts"))
    out = live.live_windowed(parsed, "ts", w.HOUR, [windows.count_rows()], w.TEN_MINUTES, ["behavior"], w.MONTH)
    return _upserted(out, "text-counts", ["behavior", *WINDOW], ["cnt"])


@query(b.UPSERT_SQL)
def stream_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    by = ["o_orderdate", "o_orderkey"]
    return _upserted(arrivals(rows, by), "orders", ["o_custkey"], by, "append")


def _halves(rows: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """The rows up to the middle of the order, which an earlier job has read, and those that arrive."""
    (low, high) = rows.agg(F.min(order), F.max(order)).first()
    middle = 0 if low is None else (low + high) // 2
    return rows.where(F.col(order) <= middle), rows.where(F.col(order) > middle)


@query(b.RUNNING_SQL)
def stream_running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by a batch query; the stream goes on from its counts."""
    history, fresh = _halves(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    known = stateful.counts_so_far(history, "event_type")
    out = stateful.live_running_count(arrivals(fresh, ["event_id"]), "event_type", "event_id", known)
    return keyed.running_sum(history, "event_type", ["event_id"]).unionByName(_appended(out, "running"))


@query(b.CHANGELOG_SQL)
def stream_retract_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by a batch query; the stream withdraws what that gave last."""
    history, fresh = _halves(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    known = stateful.counts_so_far(history, "event_type")
    out = stateful.live_changelog(arrivals(fresh, ["event_id"]), "event_type", "event_id", known)
    return keyed.changelog(history, "event_type", ["event_id"]).unionByName(_appended(out, "changelog"))


@query(b.COUNT_5_2_SQL)
def stream_count_window_5_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    out = stateful.live_count_window(arrivals(rows, ["event_id"]), "user_id", "value", "event_id", 5, 2)
    fired = _appended(out, "count-window")
    return fired.select("user_id", "fired_at", F.round("total", 2).alias("sum_value"))


@query(b.JUMP_SQL)
def stream_jump_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History by a batch query; the stream compares with the last value of each key in it."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    history, fresh = _halves(rows, "event_id")
    known = stateful.last_values(history, "user_id", "value", "event_id")
    out = stateful.live_jump_alert(arrivals(fresh, ["event_id"]), "user_id", "value", "ts", "event_id", b.JUMP, known)
    return keyed.jump_alert(history, "user_id", "value", "ts", ["event_id"], b.JUMP).unionByName(_appended(out, "jumps"))


def _stamped(rows: DataFrame, by: list[str], ts: str, delay: timedelta, until: timedelta) -> DataFrame:
    """The rows as a stream with their clock, stamped by a first query; a last row moves the clock on."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "stamped")
    _run(arrivals(rows, by), stamped.stamp(path, ts, by, delay), path)
    seen = stamped.seen_ms(spark, path)
    if seen is not None:
        stamped.close(spark, rows, path, seen + millis(until))
    return stamped.clocked(stamped.stamped_stream(rows, path), ts, delay)


@query(b.RISE_SQL + " AND ts_ms + 18000000 <= (SELECT max(epoch_us(ts) // 1000) FROM events)")
def stream_sustained_rise_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts that are due by the largest time the stream has seen, by timers."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    marked = _stamped(rows, ["event_id"], "ts", timedelta(0), timedelta(milliseconds=1))
    out = stateful.live_sustained_rise(marked, "user_id", "value", "ts", "event_id", b.RISE_SPAN, clock=stamped.CLOCK)
    return _appended(out, "rises")


@query(w.FIRINGS_SQL)
def stream_window_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each result of a window as a row of its own, when it is given."""
    marked = _stamped(w.jittered(spark, sf_dir), w.ARRIVAL, "ts", w.DELAY, 2 * w.TEN_MINUTES)
    out = stateful.live_window_firings(
        marked, "ts", "event_type", "value", w.ARRIVAL, w.TEN_MINUTES, w.LATENESS, ["event_id", "value"])
    return _appended(out, "firings")


def _split(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Accepted and late rows of the arrivals; gives the stream of the accepted ones."""
    write = lateness.split_late(path, "ts", w.ARRIVAL, w.TEN_MINUTES, delay=w.DELAY, lateness=w.LATENESS)
    rows = w.jittered(spark, sf_dir)
    _run(arrivals(rows, w.ARRIVAL), write, path)
    return lateness.accepted_stream(rows, path)


@query(f"WITH {w.STATUS_CTE} SELECT {w.LATE_COLUMNS} FROM status WHERE status = 'late'")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "late")
    _split(spark, sf_dir, path)
    return spark.read.parquet(f"{path}/late").drop("batch_id")


@query(f"""
WITH {w.STATUS_CTE}
SELECT event_type, window_start, window_end, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, window_end ORDER BY value, event_id) AS rn
  FROM status WHERE status <> 'late') WHERE rn = 1
""")
def stream_window_with_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over the accepted rows, emitted again for each change, newest result per window."""
    accepted = _split(spark, sf_dir, scratch_path(spark, "accepted"))
    kept = lateness.kept_events(accepted, "ts", w.DELAY, w.LATENESS)
    best = windows.extreme_row(kept, "ts", w.TEN_MINUTES, ["event_type"], "value", "event_id", "min", ["event_id", "value"])
    return _upserted(best, "newest", ["event_type", *WINDOW], ["event_id"])
