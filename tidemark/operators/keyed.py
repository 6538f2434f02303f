"""Per-key running results and alerts, replayed in arrival order."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.messages import jump_message, rise_message
from tidemark.functions.timing import epoch_millis, millis
from tidemark.operators.scan import BLOCK, Running, cut, running, split

#: Rows of a rise: the last one before a micro-batch, one whose alert is not yet due, a new one.
LAST, PENDING, NEW = 0, 1, 2


def with_running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    values: dict[str, Running],
    rows_per_block: int | None = None,
) -> DataFrame:
    """Rows with running values per key."""
    def work(rows: DataFrame) -> DataFrame:
        return running(rows, keys, order, values).drop(BLOCK)

    return split(df, keys, order, work, rows_per_block)


def running_sum(
    df: DataFrame,
    key: str,
    order: list[str],
    value: Column | None = None,
    name: str = "cnt",
    rows_per_block: int | None = None,
) -> DataFrame:
    """One updated sum per input row; without a value, a running count."""
    addend = F.lit(1).cast("long") if value is None else value
    return with_running(df, [key], order, {name: Running("sum", addend)}, rows_per_block)


def changelog(
    df: DataFrame, key: str, order: list[str], rows_per_block: int | None = None
) -> DataFrame:
    """Changes of a count per key: the old count is withdrawn before the new one is added."""
    counted = running_sum(df.select(key, *order), key, order, rows_per_block=rows_per_block)
    return count_changes(counted, key, order)


def count_changes(counted: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The messages behind a running count ``cnt``."""
    n = F.col("cnt")
    add = F.struct(F.lit("+").alias("op"), n.alias("cnt"))
    withdraw = F.struct(F.lit("-").alias("op"), (n - 1).alias("cnt"))
    messages = F.when(n == 1, F.array(add)).otherwise(F.array(withdraw, add))
    return counted.select(*order, key, F.explode(messages).alias("m")).select(*order, key, "m.*")


def jump_alert(
    df: DataFrame,
    key: str,
    value: str,
    ts: str,
    order: list[str],
    threshold: float,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Rows whose value is more than the threshold away from the key's row before."""
    rows = df.select(*dict.fromkeys([*order, key, value, ts]))
    rows = with_running(rows, [key], order, {"previous": Running("prev", F.col(value))}, rows_per_block)
    return rows.where(F.abs(F.col(value) - F.col("previous")) > threshold).select(
        *order,
        jump_message(F.col(ts), F.col(key), threshold).alias("message"),
        "previous",
        F.col(value).alias("current"),
    )


def _rise_marks(rows: DataFrame, key: str, span: timedelta) -> DataFrame:
    """The state of a key at each of its rows (``asks`` 0) and ``span`` after them (``asks`` 1).

    ``run`` is the run of the row; ``run_then`` and ``rises`` are the run of its key at time
    ``t`` and the rises in it. A drop starts a new run, an equal value changes nothing.

    Rows of a live stream have a ``kind``: the ``LAST`` row of a key brings the start of its run and
    the rises in it, a ``PENDING`` row of that run only asks at its time.
    """
    live = "kind" in rows.columns
    pending = rows.where(F.col("kind") == PENDING) if live else None
    rows = rows.where(F.col("kind") != PENDING) if live else rows
    extra = ["v", "start_ms", "rises_in", "kind"] if live else []
    at, by_time = F.col("ts_ms"), ["ts_ms", "seq"]
    blocked = [BLOCK] if BLOCK in rows.columns else []
    seen = running(
        rows, [key], by_time, {"prev": Running("prev", F.col("v")), "before": Running("prev", F.lit(1))}
    )
    drop, rise = F.col("v") < F.col("prev"), F.col("v") > F.col("prev")
    begins = F.col("before").isNull() | F.coalesce(drop, F.lit(False))
    flagged = seen.select(
        key, *blocked, "ts_ms", "seq", *extra, drop.alias("drop"), rise.alias("rise"), begins.alias("begins")
    )
    ups = F.when(F.col("rise"), 1).otherwise(0)
    rises_in = F.coalesce("rises_in", F.lit(0)) if live else F.lit(0)
    start = F.coalesce("start_ms", at) if live else at
    # Runs begin in time order, so the latest start is the maximum.
    counted = running(
        flagged,
        [key],
        by_time,
        {
            "run": Running("sum", F.when(F.col("drop"), 1).otherwise(0)),
            "ups": Running("sum", ups + rises_in if live else ups),
            "run_start_ms": Running("max", F.when(F.col("begins"), start)),
        },
    )
    # "run", "ups" and its value at the start of a run never fall, so the last is the maximum.
    own = F.struct(at.alias("t"), F.lit(0).alias("asks"))
    due = F.struct((at + millis(span)).alias("t"), F.lit(1).alias("asks"))
    asked = F.when(F.col("kind") == NEW, F.array(own, due)).otherwise(F.array(own)) if live else F.array(own, due)
    base = F.col("ups") - rises_in if live else F.col("ups")
    marks = counted.select(
        key, "seq", *extra[:1], "run", "run_start_ms", "ups",
        F.when(F.col("begins"), base).alias("base"), F.inline(asked),
    )
    if live:
        asks = pending.select(
            key, "seq", F.lit(0).alias("run"), F.col("start_ms").alias("run_start_ms"), at.alias("t"), F.lit(1).alias("asks"))
        marks = marks.unionByName(asks, allowMissingColumns=True)
    if blocked:
        blocks = rows.agg(F.count_distinct(BLOCK)).first()[0]
        marks = cut(marks, [key, "t", "asks", "seq"], 2 * blocks)
    state = F.col("asks") == 0
    marks = running(
        marks,
        [key],
        ["t", "asks", "seq"],
        {
            "run_then": Running("max", F.when(state, F.col("run"))),
            "ups_then": Running("max", F.when(state, F.col("ups"))),
            "base_then": Running("max", F.when(state, F.col("base"))),
        },
    )
    rises = (F.col("ups_then") - F.col("base_then")).cast("long").alias("rises")
    return marks.select(key, "t", "asks", "seq", *extra[:1], "run", "run_start_ms", "run_then", rises)


def rise_marks(rows: DataFrame, key: str, span: timedelta, rows_per_block: int | None = None) -> DataFrame:
    """The marks of the rows of all keys, hot ones in blocks."""
    return split(rows, [key], ["ts_ms", "seq"], lambda part: _rise_marks(part, key, span), rows_per_block)


def open_rises(marks: DataFrame, key: str, until_ms: int | None) -> DataFrame:
    """What a live stream carries on: the last row of each key, and the rows that are due later."""
    columns = [F.col("seq"), F.col("v"), F.col("run_start_ms").alias("start_ms")]
    ts, rises_in = F.col("t").alias("ts_ms"), F.col("rises").alias("rises_in")
    own = F.struct(ts, *columns, rises_in, F.lit(LAST).alias("kind"))
    last = marks.where(F.col("asks") == 0).groupBy(key).agg(F.max_by(own, F.struct("t", "seq")).alias("row"))
    waits = (F.col("asks") == 1) & (F.col("t") > F.lit(until_ms)) & (F.col("run_then") == F.col("run"))
    waiting = marks.where(waits).select(key, ts, *columns, rises_in, F.lit(PENDING).alias("kind"))
    return last.select(key, "row.*").unionByName(waiting)


def rises_due(
    marks: DataFrame, key: str, min_rises: int, until_ms: int | None = None
) -> DataFrame:
    """Alerts of the rows whose run still lasts at their due time, up to a time."""
    alerts = marks.where(
        (F.col("asks") == 1) & (F.col("run_then") == F.col("run")) & (F.col("rises") >= min_rises)
    )
    if until_ms is not None:
        alerts = alerts.where(F.col("t") <= until_ms)
    message = rise_message(F.col("timer_ms"), F.col("run_start_ms"), F.col(key), F.col("rises"))
    return alerts.select(
        key, "seq", F.col("t").alias("timer_ms"), "run_start_ms", "rises"
    ).withColumn("message", message)


def sustained_rise_alert(
    df: DataFrame,
    key: str,
    value: str,
    ts: str,
    order: str,
    span: timedelta,
    min_rises: int = 5,
    at_end: str = "flush",
    rows_per_block: int | None = None,
) -> DataFrame:
    """Alert ``span`` after a row when its run of rises still lasts and has ``min_rises`` rises.

    ``at_end='flush'`` fires the alerts that are due after the last row, ``'hold'`` leaves
    them out.
    """
    if at_end not in ("flush", "hold"):
        raise ValueError("at_end must be 'flush' or 'hold'")
    rows = df.select(
        F.col(key), epoch_millis(F.col(ts)).alias("ts_ms"), F.col(order).alias("seq"), F.col(value).alias("v")
    )
    until = rows.agg(F.max("ts_ms")).first()[0] if at_end == "hold" else None

    def work(part: DataFrame) -> DataFrame:
        return rises_due(_rise_marks(part, key, span), key, min_rises, until)

    return split(rows, [key], ["ts_ms", "seq"], work, rows_per_block)
