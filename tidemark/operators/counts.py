"""Windows over a fixed number of rows of a key, in arrival order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import with_running
from tidemark.operators.scan import Running


def _numbered(df: DataFrame, key: str, order: list[str], rows_per_block: int | None) -> DataFrame:
    one = F.lit(1).cast("long")
    return with_running(df, [key], order, {"row_no": Running("sum", one)}, rows_per_block)


def tumbling_count(
    df: DataFrame,
    key: str,
    order: list[str],
    size: int,
    rows_per_block: int | None = None,
    **aggs: Column,
) -> DataFrame:
    """Aggregate each full run of ``size`` rows of a key; an incomplete run gives no row."""
    block = F.floor((F.col("row_no") - 1) / size).cast("long") + 1
    rows = _numbered(df, key, order, rows_per_block).withColumn("block_no", block)
    out = rows.groupBy(key, "block_no").agg(
        *[a.alias(n) for n, a in aggs.items()], F.count(F.lit(1)).alias("__rows")
    )
    return out.where(F.col("__rows") == size).drop("__rows")


def firings(row_no: Column, size: int, slide: int) -> Column:
    """Row numbers of the firings that cover a row, one output row each."""
    first = F.ceil(row_no / slide).cast("long") * slide
    last = row_no + (size - 1)
    return F.explode(F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long"))))


def fire(numbered: DataFrame, key: str, size: int, slide: int, aggs: dict[str, Column]) -> DataFrame:
    """Aggregate numbered rows per firing.

    Each row is sent to the firings that cover it, so that a firing is a small group of its
    own and rows of neighbouring blocks need no special case.
    """
    sent = numbered.withColumn("fired_at", firings(F.col("row_no"), size, slide))
    out = sent.groupBy(key, "fired_at").agg(
        *[a.alias(c) for c, a in aggs.items()], F.max("row_no").alias("__last")
    )
    # A firing beyond the last row of the key has not happened.
    return out.where(F.col("__last") == F.col("fired_at")).drop("__last")


def sliding_count(
    df: DataFrame,
    key: str,
    order: list[str],
    size: int,
    slide: int,
    rows_per_block: int | None = None,
    **aggs: Column,
) -> DataFrame:
    """At every ``slide``-th row of a key, aggregate its last rows, ``size`` at most."""
    return fire(_numbered(df, key, order, rows_per_block), key, size, slide, aggs)
