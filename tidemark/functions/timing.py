"""Column helpers for event time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = "yyyy-MM-dd HH:mm:ss"


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def millis(span: timedelta) -> int:
    return span // timedelta(milliseconds=1)


def interval_text(span: timedelta) -> str:
    """The span in the text form that ``window`` and ``withWatermark`` take."""
    return f"{micros(span)} microseconds"


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def clock_text(ts: Column) -> Column:
    """24-hour text in the session time zone."""
    return F.date_format(ts, CLOCK)


def shift(ts: Column, by: timedelta = timedelta(0)) -> Column:
    """Event time moved by a fixed span."""
    return ts + F.lit(by)
