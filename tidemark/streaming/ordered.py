"""A table as a plain file stream in the order its rows arrived, a bounded number of rows at a time.

The files of a table may hold its rows in any order. They are written once, cut by ranges of the
order of arrival, and get modification times that rise in that order, which is the order in which a
file stream takes them. One query then reads one file per micro-batch.
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from tidemark.session import scratch_path
from tidemark.sinks.folders import data_files, set_time

BATCH_ROWS = 1_000_000
LEAST_FILES = 3
FILLED = 0.9  # ranges are cut by a sample, and one that is above the bound would need a second file
STEP_MS = 10
ROW_GROUP = {"parquet.block.size": 4 << 20}  # so that more than one task reads a file


def arrival_files(
    rows: DataFrame, by: Sequence[str | Column], last: DataFrame | None = None, form: str = "parquet",
    keep: Sequence[str] | None = None, batch_rows: int | None = None,
) -> str:
    """Write the rows as files in the order ``by``; gives the folder.

    No file holds more than ``batch_rows`` rows. ``last`` are rows for a last file of their own, such as
    one that closes all windows; ``keep`` are the columns that the files hold if not all.
    """
    spark, limit = rows.sparkSession, batch_rows or BATCH_ROWS
    folder = scratch_path(spark, "arrivals")
    files = max(LEAST_FILES, math.ceil(rows.count() / (FILLED * limit)))
    ranged = rows.repartitionByRange(files, *by).sortWithinPartitions(*by)
    ranged = ranged.select(*keep) if keep else ranged
    ranged.write.options(maxRecordsPerFile=limit, **ROW_GROUP).format(form).save(folder)
    names = data_files(spark, folder)
    if last is not None:
        last.coalesce(1).write.mode("append").format(form).save(folder)
        names += sorted(set(data_files(spark, folder)) - set(names))
    begin = int(time.time() * 1000) - STEP_MS * len(names)
    for k, name in enumerate(names):
        set_time(spark, name, begin + STEP_MS * k)
    return folder


def file_stream(rows: DataFrame, folder: str, form: str = "parquet", files: int = 1) -> DataFrame:
    """The files of a folder as a stream, ``files`` at a time; ``rows`` gives the schema."""
    reader = rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files)
    return reader.format(form).load(folder)


def arrivals(rows: DataFrame, by: Sequence[str | Column], last: DataFrame | None = None, **more) -> DataFrame:
    """The rows as a stream in the order of arrival."""
    keep = more.get("keep")
    folder = arrival_files(rows, by, last, **more)
    return file_stream(rows.select(*keep) if keep else rows, folder, more.get("form", "parquet"))
