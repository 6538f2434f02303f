"""Ranking within windows and the text report of a ranking."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.messages import REPORT_HEADER, REPORT_RULE
from tidemark.functions.timing import clock_text
from tidemark.operators.windows import END, count_rows, windowed

RANK = "row_num"


def top_n(df: DataFrame, group: str, value: str, key: str, n: int = 5) -> DataFrame:
    """The ``n`` rows with the largest value per group, ranked; ties go to the smaller key.

    Spark keeps the best ``n`` of each task before the shuffle, so a large group is no burden.
    """
    w = Window.partitionBy(group).orderBy(F.desc(value), key)
    rank = F.row_number().over(w)
    return df.withColumn(RANK, rank).where(F.col(RANK) <= n).withColumn(RANK, F.col(RANK).cast("long"))


def hot_keys(
    df: DataFrame,
    ts: str,
    key: str,
    size: timedelta = timedelta(hours=1),
    slide: timedelta = timedelta(minutes=10),
    n: int = 5,
) -> DataFrame:
    """The most frequent keys of each window."""
    counts = windowed(df, ts, size, [count_rows()], slide, [key]).select(key, END, "cnt")
    return top_n(counts, END, "cnt", key, n)


TOP_N_SQL = """
SELECT * FROM (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY {group} ORDER BY {value} DESC, {key}) AS BIGINT)
         AS row_num
  FROM {view}) ranked
WHERE row_num <= {n}
"""


def top_n_sql(view: str, group: str, value: str, key: str, n: int = 5) -> str:
    """The same ranking as a query over a registered view."""
    return TOP_N_SQL.format(view=view, group=group, value=value, key=key, n=n)


def report(df: DataFrame, key: str, key_label: str, count_label: str) -> DataFrame:
    """One text per window from ranked rows (``window_end``, key, ``cnt``, ``row_num``)."""
    line = F.concat(
        F.lit("Top"), F.col(RANK), F.lit(f"\t{key_label}"), F.col(key),
        F.lit(f"\t{count_label}"), F.col("cnt"), F.lit("\n"),
    )
    lines = F.array_sort(F.collect_list(F.struct(RANK, line.alias("line"))))
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "")
    text = F.concat(
        F.lit(REPORT_HEADER), clock_text(F.col(END)), F.lit("\n"),
        F.col("body"), F.lit(f"\n{REPORT_RULE}\n"),
    )
    return df.groupBy(END).agg(body.alias("body")).select(END, text.alias("report"))
