"""Lookup of one matching row in a side table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_CHARS = 256 * 1024 * 1024


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a table is small enough, in rows and in text size, to send to every task."""
    capped = df.limit(MAX_BROADCAST_ROWS + 1)
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, chars = capped.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= MAX_BROADCAST_ROWS and chars <= MAX_BROADCAST_CHARS


def first_match(
    left: DataFrame, right: DataFrame, key: str, position: str, how: str = "strict"
) -> DataFrame:
    """Each left row with the right row of its key that comes first by ``position``.

    A key without a match fails the job (``strict``), drops the row (``inner``) or leaves
    nulls (``left``). The right side is broadcast when it is small; otherwise Spark joins by
    shuffle and splits skewed keys.
    """
    if how not in ("strict", "inner", "left"):
        raise ValueError("how must be 'strict', 'inner' or 'left'")
    fields = [c for c in right.columns if c not in (key, position)]
    once = right.groupBy(key).agg(F.min_by(F.struct(*fields), position).alias("match"))
    # "once" is never larger than the side it comes from.
    if fits_broadcast(right.select(key, *fields)):
        once = F.broadcast(once)
    joined = left.join(once, key, "inner" if how == "inner" else "left")
    match = F.col("match")
    if how == "strict":
        missing = F.raise_error(F.concat_ws(" ", F.lit(f"no match for {key}"), F.col(key).cast("string")))
        match = F.when(match.isNull(), missing).otherwise(match)
    return joined.withColumn("match", match).select(
        *left.columns, *[F.col("match")[c].alias(c) for c in fields]
    )
