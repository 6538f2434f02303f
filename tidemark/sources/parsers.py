"""Delimited lines and access logs as typed columns. A bad or short line fails the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.schemas import struct

ACCESS_TIME = "dd/MM/yyyy:HH:mm:ss"


def _at(parts: Column, i: int) -> Column:
    """Field ``i`` of a split line; a line that is too short raises."""
    return F.element_at(parts, i + 1)


def _padded(text: Column) -> Column:
    return F.raise_error(F.concat(F.lit("blanks around a number: '"), text, F.lit("'")))


def parse_delimited(
    df: DataFrame, schema: str, line: str = "value", sep: str = ",", tolerant: bool = False
) -> DataFrame:
    """The fields of a line, cast by position to the schema; other columns are kept.

    ``sep`` is taken as it stands. Blanks around a number are malformed. ``tolerant`` gives null
    for a missing or malformed field instead of failing.
    """
    parts = F.split(F.col(line), "".join(c if c.isalnum() else f"\\{c}" for c in sep))
    fields = []
    for i, f in enumerate(struct(schema).fields):
        text = F.get(parts, F.lit(i)) if tolerant else _at(parts, i)
        if not isinstance(f.dataType, StringType):
            text = F.when(text.rlike("^\\s|\\s$"), F.lit(None) if tolerant else _padded(text)).otherwise(text)
        fields.append((text.try_cast(f.dataType) if tolerant else text.cast(f.dataType)).alias(f.name))
    return df.select(*[c for c in df.columns if c != line], *fields)


def parse_access_log(df: DataFrame, line: str = "value") -> DataFrame:
    """Address, time in epoch milliseconds, zone, method and url of a log line.

    Fields are parted by single spaces; the second and third are skipped. The zone is kept
    as text and not applied.
    """
    parts = F.split(F.col(line), " ")
    time = F.to_timestamp(_at(parts, 3), ACCESS_TIME)
    return df.select(
        *[c for c in df.columns if c != line],
        _at(parts, 0).alias("ip"),
        F.unix_millis(time).alias("ts_ms"),
        _at(parts, 4).alias("timezone"),
        _at(parts, 5).alias("way"),
        _at(parts, 6).alias("url"),
    )
