"""Running values per key in arrival order, split so that no key fills one task.

A plain ``sum(...) over (partition by key order by arrival)`` puts every row of a key in
one task. Here the rows of keys above ``rows_per_block`` are range-partitioned by the key and
the whole order tuple and written once with the number of their range. Each block is summarised,
the summaries are scanned per key (one row per block), and the value carried into a block is
joined back to its rows. Keys below the bound take the plain window, with one shuffle.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.session import written

ROWS_PER_BLOCK = 2_000_000
SAMPLE_PER_BLOCK = 1_000
BLOCK = "__block"
_FIRST = "__first_of_block"


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality with the renamed keys of the other side."""
    return functools.reduce(
        operator.and_, [left[k].eqNullSafe(right[prefix + k]) for k in keys]
    )


def renamed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({k: prefix + k for k in keys})


@dataclass(frozen=True)
class Hot:
    """Keys with more rows than a task should hold, and the blocks that their rows need."""

    keys: tuple[str, ...]
    table: DataFrame
    blocks: int

    def part(self, df: DataFrame, how: str) -> DataFrame:
        side = renamed(self.table, self.keys, "__hot_")
        return df.join(side, same_keys(df, side, self.keys, "__hot_"), how)


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_block: int | None = None) -> Hot | None:
    """The keys above the bound, by a sample of about 1000 rows for each block.

    A wrong guess costs time and changes no result. Hot keys are counted first; only if there are some
    are they written, so Spark knows their size and sends them to every task only if they are few.
    """
    limit = rows_per_block or ROWS_PER_BLOCK
    share = min(1.0, SAMPLE_PER_BLOCK / limit)
    sample = df.sample(share, seed=1) if share < 1 else df
    rows = F.count(F.lit(1)).alias("__rows")
    hot = sample.groupBy(*keys).agg(rows).where(F.col("__rows") > limit * share)
    sampled = hot.agg(F.sum("__rows")).first()[0]
    if sampled is None:
        return None
    return Hot(tuple(keys), written(hot.select(*keys), "hot-keys"), max(2, math.ceil(sampled / share / limit)))


def cut(df: DataFrame, by: Sequence[str], blocks: int) -> DataFrame:
    """The rows, written once, with the number of their block in the order of ``by``."""
    ranged = df.repartitionByRange(blocks, *by).withColumn(BLOCK, F.spark_partition_id())
    return written(ranged, "blocks")


@dataclass(frozen=True)
class Running:
    """A running value: ``sum``, ``max`` or ``min`` up to the row, or ``prev`` = the row before."""

    how: str
    column: Column
    with_current: bool = True

    def in_block(self, w: WindowSpec) -> Column:
        if self.how == "prev":
            return F.lag(self.column).over(w)
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if self.with_current else -1)
        value = getattr(F, self.how)(self.column).over(frame)
        return F.coalesce(value, F.lit(0)) if self.how == "sum" else value

    def summary(self, order: Sequence[str]) -> Column:
        if self.how == "prev":
            last = F.col(order[0]) if len(order) == 1 else F.struct(*order)
            return F.max_by(self.column, last)
        return getattr(F, self.how)(self.column)

    def carry(self, summary: Column, w: WindowSpec) -> Column:
        if self.how == "prev":
            return F.lag(summary).over(w)
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        return getattr(F, self.how)(summary).over(frame)

    def joined(self, value: Column, carry: Column) -> Column:
        if self.how == "prev":
            return F.when(F.col(_FIRST), carry).otherwise(value)
        if self.how == "sum":
            return value + F.coalesce(carry, F.lit(0))
        pick = F.greatest if self.how == "max" else F.least
        return F.when(value.isNull(), carry).when(carry.isNull(), value).otherwise(pick(value, carry))


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Running]
) -> DataFrame:
    """Add running values to the rows; if ``cut`` has numbered their blocks, block by block.

    ``order`` must be unique within a key.
    """
    group = [*keys, BLOCK] if BLOCK in df.columns else list(keys)
    w = Window.partitionBy(*group).orderBy(*order)
    local = df.select("*", *[v.in_block(w).alias(n) for n, v in values.items()])
    if BLOCK not in df.columns:
        return local

    across = Window.partitionBy(*keys).orderBy(BLOCK)
    summary = df.groupBy(*group).agg(*[v.summary(order).alias(n) for n, v in values.items()])
    carry = summary.select(
        *[F.col(k).alias(f"__in_{k}") for k in group],
        *[v.carry(F.col(n), across).alias(f"__carry_{n}") for n, v in values.items()],
        F.lag(F.lit(True)).over(across).alias("__later"),
    ).where("__later")
    local = local.withColumn(_FIRST, F.row_number().over(w) == 1)
    both = local.join(carry, same_keys(local, carry, group, "__in_"), "left")
    return both.select(
        *df.columns,
        *[v.joined(F.col(n), F.col(f"__carry_{n}")).alias(n) for n, v in values.items()],
    )


def split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    work: Callable[[DataFrame], DataFrame],
    rows_per_block: int | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """``work`` over the rows of small keys as they are, and over those of hot keys in blocks.

    Keys are counted in ``sized_by`` if the rows themselves are dear to compute.
    """
    hot = hot_keys((df if sized_by is None else sized_by).select(*keys), keys, rows_per_block)
    if hot is None:
        return work(df)
    blocked = cut(hot.part(df, "left_semi"), [*keys, *order], hot.blocks)
    return work(hot.part(df, "left_anti")).unionByName(work(blocked))
