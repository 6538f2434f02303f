"""Late rows of a live stream as a second output.

Spark drops late rows before an operator sees them. So a first query sorts the rows of each
micro-batch into accepted and late ones by the watermark it stamps them with, and a second query
aggregates the accepted rows; how the input is cut into batches makes no difference.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame

from tidemark.operators.lateness import WATERMARK, is_late
from tidemark.sources.readers import event_table
from tidemark.streaming.stamped import stamp, stamped_stream


def split_late(
    path: str,
    ts: str,
    arrival: Sequence[str],
    size: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = timedelta(0),
    lateness: timedelta = timedelta(0),
    rows_per_block: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes ``accepted``, ``late`` and the time seen so far."""

    def parts(rows: DataFrame) -> dict[str, DataFrame]:
        late = is_late(ts, size, slide, lateness)
        return {"accepted": rows.where(~late).drop(WATERMARK), "late": rows.where(late).drop(WATERMARK)}

    return stamp(path, ts, arrival, delay, parts, rows_per_block)


def accepted_stream(rows: DataFrame, path: str) -> DataFrame:
    """The accepted rows of ``split_late`` as a stream; ``rows`` gives the schema."""
    return stamped_stream(rows, path, "accepted")


def kept_events(
    accepted: DataFrame, ts: str, delay: timedelta, lateness: timedelta
) -> DataFrame:
    """Accepted rows with a watermark that keeps windows for the allowed lateness.

    In update mode an aggregate over it gives a new result for each window a late row changes.
    """
    return event_table(accepted, ts, delay + lateness)
