"""Watermarks, allowed lateness and late rows, replayed in arrival order.

Before each row the watermark is the largest event time seen so far minus the delay. All
times are whole milliseconds. For a row and a window that ends at ``end``:

- ``on_time``: the window has not fired, ``end - 1 > watermark``;
- ``refire``: it has fired and is still kept, ``end - 1 + lateness > watermark``;
- ``late``: its state is gone.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import epoch_millis, from_millis, millis
from tidemark.operators.scan import BLOCK, ROWS_PER_BLOCK, Running, cut, running, split
from tidemark.operators.windows import END, START, checked_slide

ASCENDING = timedelta(milliseconds=1)
NO_WATERMARK = -(2**62)
WATERMARK = "watermark_ms"
STATUS = "status"


def with_watermark_before(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    delay: timedelta = ASCENDING,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Add the watermark that holds when a row arrives.

    The running maximum over all rows is taken per block of arrivals; only the block
    maxima (one row per block) meet in one task. Rows that fit into one block are not written.
    """
    blocks = math.ceil(df.count() / (rows_per_block or ROWS_PER_BLOCK))
    seen = {"__seen": Running("max", epoch_millis(F.col(ts)), with_current=False)}
    rows = running(cut(df, arrival, blocks) if blocks > 1 else df, [], list(arrival), seen)
    mark = F.coalesce(F.col("__seen") - millis(delay), F.lit(NO_WATERMARK))
    return rows.withColumn(WATERMARK, mark).drop("__seen", BLOCK)


def _status(end_ms: Column, lateness: timedelta) -> Column:
    last = end_ms - 1
    return (
        F.when(last > F.col(WATERMARK), "on_time")
        .when(last + millis(lateness) > F.col(WATERMARK), "refire")
        .otherwise("late")
    )


def _last_end(ts_ms: Column, size: int, slide: int) -> Column:
    """End of the latest window that holds a time."""
    return ts_ms - F.pmod(ts_ms, F.lit(slide)) + size


def with_windows(
    df: DataFrame, ts: str, size: timedelta, slide: timedelta | None = None
) -> DataFrame:
    """One row per row and window it falls in, with the bounds of the window."""
    step, width = millis(checked_slide(size, slide)), millis(size)
    ms = epoch_millis(F.col(ts))
    last = _last_end(ms, width, step)
    # Ends run back from the latest one while the window still holds the row.
    first = last - F.floor((last - ms - 1) / step).cast("long") * step
    ends = F.explode(F.sequence(first, last, F.lit(step).cast("long")))
    kind = df.schema[ts].dataType.simpleString()
    bounds = {
        START: from_millis(F.col("__end") - width).cast(kind),
        END: from_millis(F.col("__end")).cast(kind),
    }
    return df.withColumn("__end", ends).withColumns(bounds).drop("__end")


def classify_late(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = ASCENDING,
    lateness: timedelta = timedelta(0),
    rows_per_block: int | None = None,
) -> DataFrame:
    """Status of each row in each window it falls in."""
    rows = with_watermark_before(df, ts, arrival, delay, rows_per_block)
    rows = with_windows(rows, ts, size, slide)
    return rows.withColumn(STATUS, _status(epoch_millis(F.col(END)), lateness))


def late_rows(
    df: DataFrame,
    ts: str,
    arrival: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = ASCENDING,
    lateness: timedelta = timedelta(0),
    rows_per_block: int | None = None,
) -> DataFrame:
    """The second output: rows that are late in all their windows, that is in the latest one."""
    rows = with_watermark_before(df, ts, arrival, delay, rows_per_block)
    return rows.where(is_late(ts, size, slide, lateness)).select(*df.columns)


def is_late(ts: str, size: timedelta, slide: timedelta | None, lateness: timedelta) -> Column:
    """Whether the latest window of a row is gone at the watermark the row carries."""
    end = _last_end(epoch_millis(F.col(ts)), millis(size), millis(checked_slide(size, slide)))
    return _status(end, lateness) == "late"


def window_firings(
    classified: DataFrame,
    keys: Sequence[str],
    value: str,
    arrival: Sequence[str],
    columns: Sequence[str],
    pick: str = "min",
    unclassified: DataFrame | None = None,
    rows_per_block: int | None = None,
) -> DataFrame:
    """Every result a window emits: one over its on-time rows, then one per re-firing row.

    Each result is the full row with the smallest (or largest) value so far; the first in
    arrival order on ties. Rows of ``classified`` must have a unique arrival. Sizes of windows
    are estimated from ``unclassified`` (the input through ``with_windows``) if it is given,
    which saves a second classification.
    """
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    group = [*keys, START, END]
    sign = 1 if pick == "min" else -1
    rank = [(F.col(value) * sign).alias("__rank"), *[F.col(a).alias(f"__a{i}") for i, a in enumerate(arrival)]]
    refire = F.col(STATUS) == "refire"
    at = [F.when(refire, F.col(a)).alias(f"__at{i}") for i, a in enumerate(arrival)]
    names = [f"__at{i}" for i in range(len(arrival))]

    accepted = classified.where(F.col(STATUS) != "late")
    best = F.min(F.struct(*rank, F.struct(*columns).alias("row"))).alias("best")
    # On-time rows of a window collapse to one row here; re-firing rows stay apart.
    steps = accepted.groupBy(*group, *at).agg(best)
    values = {"firing_no": Running("sum", F.lit(1).cast("long")), "so_far": Running("min", F.col("best"))}

    def work(part: DataFrame) -> DataFrame:
        return running(part, group, names, values).select(*group, "firing_no", "so_far.row.*")

    return split(steps, group, names, work, rows_per_block, accepted if unclassified is None else unclassified)


def window_with_lateness(
    classified: DataFrame,
    keys: Sequence[str],
    value: str,
    arrival: Sequence[str],
    columns: Sequence[str],
    pick: str = "min",
) -> DataFrame:
    """The last result of each window: its on-time and re-firing rows together."""
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    sign = 1 if pick == "min" else -1
    rank = F.struct((F.col(value) * sign).alias("r"), *arrival)
    grouped = classified.where(F.col(STATUS) != "late").groupBy(*keys, START, END)
    return grouped.agg(F.min_by(F.struct(*columns), rank).alias("row")).select(*keys, START, END, "row.*")
