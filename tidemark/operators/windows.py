"""Event-time windows.

Windows are half-open, aligned to the epoch, and give a row only where they hold one. A
sliding window whose size is a multiple of its slide is computed in panes: rows are
aggregated once per slide-wide pane and the panes, not the rows, are copied to the windows
they belong to.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timing import interval_text

START, END = "window_start", "window_end"
ROWS_PER_TASK = 500_000


@dataclass(frozen=True)
class Mergeable:
    """An aggregate in three steps: accumulate rows, merge accumulators, give the result."""

    add: dict[str, Column]
    merge: dict[str, Column]
    result: dict[str, Column]


def count_rows(name: str = "cnt") -> Mergeable:
    part = f"{name}_part"
    return Mergeable(
        {part: F.count(F.lit(1))}, {part: F.sum(part)}, {name: F.col(part)}
    )


def sum_of(value: Column, name: str) -> Mergeable:
    part = f"{name}_part"
    return Mergeable({part: F.sum(value)}, {part: F.sum(part)}, {name: F.col(part)})


def first_of(value: Column, order: Column, name: str) -> Mergeable:
    """The value of the first row in arrival order."""
    part, at = f"{name}_part", f"{name}_at"
    return Mergeable(
        {part: F.min_by(value, order), at: F.min(order)},
        {part: F.min_by(part, at), at: F.min(at)},
        {name: F.col(part)},
    )


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0; rows with 0 still open their window."""
    return F.when(condition, 1).otherwise(0).cast("long")


def window_start(ts: Column, size: timedelta, slide: timedelta | None = None) -> Column:
    """Start of the window of a row; with a slide, one row per window it falls in."""
    slide_text = interval_text(slide) if slide else None
    return F.window(ts, interval_text(size), slide_text)["start"]


def checked_slide(size: timedelta, slide: timedelta | None) -> timedelta:
    """The slide, which is the size for a tumbling window."""
    if slide is not None and not timedelta(0) < slide <= size:
        raise ValueError("the slide must be positive and not longer than the size")
    return slide or size


def windowed(
    df: DataFrame,
    ts: str,
    size: timedelta,
    aggs: Sequence[Mergeable],
    slide: timedelta | None = None,
    keys: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """Mergeable aggregates per key and tumbling or sliding window.

    With ``tasks``, panes are merged in so many tasks, dealt by the keys before they are copied to their
    windows; for many keys, where copies of different tasks would hardly meet before a shuffle.
    """
    slide = checked_slide(size, slide)
    add = [c.alias(n) for a in aggs for n, c in a.add.items()]
    results = [c.alias(n) for a in aggs for n, c in a.result.items()]

    # A stream keeps its state per window, so there the rows are copied.
    if size % slide or df.isStreaming:
        w = F.window(F.col(ts), interval_text(size), interval_text(slide))
        grouped = df.groupBy(*keys, w.alias("w")).agg(*add)
        return grouped.select(*keys, F.col("w.start").alias(START), F.col("w.end").alias(END), *results)

    panes = df.groupBy(*keys, F.window(F.col(ts), interval_text(slide)).alias("w")).agg(*add)
    panes = panes.withColumn(START, F.col("w.start")).drop("w")
    if size != slide:
        merge = [c.alias(n) for a in aggs for n, c in a.merge.items()]
        if keys and tasks:
            panes = panes.repartition(tasks, *keys)
        panes = panes.withColumn(START, covering_starts(F.col(START), size, slide))
        panes = panes.groupBy(*keys, START).agg(*merge)
    return panes.select(*keys, START, (F.col(START) + F.lit(size)).alias(END), *results)


def covering_starts(pane: Column, size: timedelta, slide: timedelta) -> Column:
    """Starts of the windows that cover a pane, one row each."""
    return F.explode(F.sequence(pane - F.lit(size - slide), pane, F.lit(slide)))


def distinct_count(
    df: DataFrame,
    ts: str,
    value: str,
    size: timedelta,
    slide: timedelta | None = None,
    keys: Sequence[str] = (),
    name: str = "uv",
) -> DataFrame:
    """Number of distinct values per window: each value once per pane, then once per window."""
    slide = checked_slide(size, slide)
    if size % slide:
        raise ValueError("the size must be a multiple of the slide")
    pane = F.window(F.col(ts), interval_text(slide))["start"].alias(START)
    once = df.select(*keys, value, pane).distinct()
    if size != slide:
        once = once.withColumn(START, covering_starts(F.col(START), size, slide)).distinct()
    out = once.groupBy(*keys, START).agg(F.count(value).alias(name))
    return out.select(*keys, START, (F.col(START) + F.lit(size)).alias(END), name)


def extreme_row(
    df: DataFrame,
    ts: str,
    size: timedelta,
    keys: Sequence[str],
    value: str,
    order: str,
    pick: str,
    columns: Sequence[str],
    slide: timedelta | None = None,
) -> DataFrame:
    """The full row with the largest or smallest value per key and window; first in arrival on ties."""
    row = F.struct(*columns)
    if pick == "max":
        best = F.max_by(row, F.struct(F.col(value), -F.col(order)))
    elif pick == "min":
        best = F.min_by(row, F.struct(F.col(value), F.col(order)))
    else:
        raise ValueError("pick must be 'max' or 'min'")
    slide_text = interval_text(slide) if slide else None
    w = F.window(F.col(ts), interval_text(size), slide_text)
    grouped = df.groupBy(*keys, w.alias("w")).agg(best.alias("best"))
    return grouped.select(*keys, F.col("w.start").alias(START), F.col("w.end").alias(END), "best.*")
