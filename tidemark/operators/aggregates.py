"""Aggregates without a time window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import word_rows


def word_count(lines: DataFrame, line: str = "value") -> DataFrame:
    return word_rows(lines, line).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def group_count(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


GROUP_COUNT_SQL = "SELECT {key}, count(*) AS cnt FROM {view} GROUP BY {key}"


def counts_where(df: DataFrame, total: str = "total", **conditions: Column) -> DataFrame:
    """The number of all rows and of the rows that meet each condition, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias(total),
        *[F.count_if(c).alias(n) for n, c in conditions.items()],
    )


def _best(pick: str, columns: Sequence[str], value: str, tie: str) -> Column:
    row = F.struct(*columns)
    if pick == "max":
        return F.max_by(row, F.struct(F.col(value), -F.col(tie)))
    return F.min_by(row, F.struct(F.col(value), F.col(tie)))


def row_of(
    df: DataFrame, value: str, tie: str, pick: str, by: Sequence[str] = ()
) -> DataFrame:
    """The full row with the smallest or largest value, overall or per group.

    Equal values go to the smaller ``tie``, which must be numeric and unique.
    """
    if pick not in ("min", "max"):
        raise ValueError("pick must be 'min' or 'max'")
    best = _best(pick, df.columns, value, tie).alias("best")
    out = df.groupBy(*by).agg(best) if by else df.agg(best)
    return out.select("best.*")


def extremes(df: DataFrame, value: str, tie: str, by: str) -> DataFrame:
    """Smallest and largest row of each group and of all rows, in one pass over the data.

    The overall rows come from the rows of the groups, so the input is read once.
    """
    columns = df.columns
    groups = df.groupBy(by).agg(
        _best("min", columns, value, tie).alias("low"), _best("max", columns, value, tie).alias("high")
    )
    scope = F.array(
        F.struct(F.lit(False).alias("overall"), F.col(by).alias("of")),
        F.struct(F.lit(True).alias("overall"), F.lit(None).cast(df.schema[by].dataType).alias("of")),
    )
    scoped = groups.withColumn("scope", F.explode(scope))
    low = F.struct(*[F.col(f"low.{c}").alias(c) for c in (value, tie)])
    high = F.struct(F.col(f"high.{value}").alias("v"), (-F.col(f"high.{tie}")).alias("t"))
    picked = scoped.groupBy("scope").agg(
        F.min_by("low", low).alias("low"), F.max_by("high", high).alias("high")
    )
    sides = F.explode(
        F.array(
            F.struct(F.lit("min").alias("pick"), F.col("low").alias("row")),
            F.struct(F.lit("max").alias("pick"), F.col("high").alias("row")),
        )
    )
    return picked.select("scope.overall", sides.alias("s")).select("overall", "s.pick", "s.row.*")


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Count the rows that pass this point; the number is there after the next action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("count")), seen


def long_with_prefix(df: DataFrame, column: str, longer_than: int, prefix: str) -> DataFrame:
    """Rows whose text is longer than a length and begins with a prefix."""
    text = F.col(column)
    return df.where(F.length(text) > longer_than).where(text.startswith(prefix))
