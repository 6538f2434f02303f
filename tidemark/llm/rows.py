"""Rows of a table told apart by id and text, and working columns that meet no column of a user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW = 1_000_000


def few(df: DataFrame, rows: int = FEW) -> DataFrame:
    """A written table of narrow rows: sent to every task if it has at most ``rows``, else joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of the frame has, however it is spelled."""
    taken, mark = {c.lower() for c in df.columns}, "__"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def without_rows(docs: DataFrame, mark: Column, gone: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """The documents without those of ``gone``, and one only of those in ``once``; all columns stay.

    Both tables name rows by ``doc_id`` and ``mark``, a hash of the text that the column ``mark`` gives
    for documents; null ids are ids like others. The documents themselves are shuffled only if ``gone``
    is too large to be sent to every task; those in ``once`` are put together apart.
    """
    key, there, its = free_names(docs, "key", "id", "mark")

    def named(rows: DataFrame) -> DataFrame:
        return few(rows.select(F.col("doc_id").alias(there), F.col("mark").alias(its)))

    keyed = docs.withColumn(key, F.struct(F.col("doc_id").alias("id"), mark.alias("mark")))
    same = F.col(f"{key}.id").eqNullSafe(F.col(there)) & (F.col(f"{key}.mark") == F.col(its))
    if once is None or once.isEmpty():
        return keyed.join(named(gone), same, "left_anti").drop(key)
    kept = keyed.join(named(gone), same, "left_anti").join(named(once), same, "left_anti").drop(key)
    single = keyed.join(named(once), same, "left_semi").dropDuplicates([key]).drop(key)
    return kept.unionByName(single)
