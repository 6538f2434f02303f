"""Print and text outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import label_rows


def print_rows(df: DataFrame, label: str | None = None, rows: int = 20) -> None:
    """Show a bounded table, or the first rows of it, with an optional label column."""
    shown = df.select(label_rows(label), "*") if label else df
    shown.show(rows, truncate=False)


def print_stream(stream: DataFrame, checkpoint: str, label: str | None = None, mode: str = "append") -> StreamingQuery:
    shown = stream.select(label_rows(label), "*") if label else stream
    writer = shown.writeStream.format("console").outputMode(mode).option("truncate", False)
    return writer.option("checkpointLocation", checkpoint).start()


def write_text(df: DataFrame, path: str, files: int | None = None) -> None:
    """One line per row, replacing what was there.

    ``files`` sets the number of output files where that number is part of the result.
    """
    lines = df.repartition(files) if files else df
    lines.write.mode("overwrite").text(path)
