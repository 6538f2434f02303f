"""Column helpers for lines, words and fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_lines(text: Column) -> Column:
    """Array of the lines of a text."""
    return F.split(text, "\n")


def word_rows(lines: DataFrame, line: str, name: str = "word") -> DataFrame:
    """One row per word between single spaces.

    Empty words at the end of a line are dropped; leading and inner ones stay. An empty
    line is one empty word, a line of spaces only has none.
    """
    whole, trimmed = F.col(line), F.rtrim(line)
    kept = lines.where((trimmed != "") | (whole == ""))
    return kept.select(F.explode(F.split(trimmed, " ")).alias(name))


def first_number(text: Column) -> Column:
    """The first run of digits in a text, as a long."""
    return F.regexp_extract(text, "([0-9]+)", 1).cast("long")


def label_rows(label: str) -> Column:
    """Constant column for a labelled print."""
    return F.lit(label).alias("label")
