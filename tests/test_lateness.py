from datetime import timedelta

import pytest
from fixtures import rows_of, sensors
from pyspark.sql import functions as F

from tidemark.operators import lateness as late

S = lambda n: timedelta(seconds=n)
ARRIVED = [1, 5, 12, 3, 15, 4, 18, 2]
VALUES = [7, 5, 9, 4, 9, 6, 9, 1]


def rows(spark):
    return sensors(spark, [("a", v, t) for v, t in zip(VALUES, ARRIVED)], "int")


def classified(spark, **more):
    return late.classify_late(rows(spark), "ts", ["seq"], S(10), delay=S(2), lateness=S(4), **more)


@pytest.mark.parametrize("rows_per_block", [None, 1, 3])
def test_status(spark, rows_per_block):
    df = classified(spark, rows_per_block=rows_per_block)
    got = {r.seq: (r.status, r.watermark_ms) for r in df.collect()}
    assert [got[i][0] for i in range(8)] == ["on_time"] * 3 + ["refire", "on_time", "refire", "on_time", "late"]
    assert (got[3][1], got[5][1], got[7][1]) == (10_000, 13_000, 16_000)


def test_late_rows(spark):
    df = late.late_rows(rows(spark), "ts", ["seq"], S(10), delay=S(2), lateness=S(4))
    assert rows_of(df, "seq", "ts_s") == [(7, 2)]
    assert df.columns == rows(spark).columns


def test_ascending_watermark_trails_by_a_millisecond(spark):
    df = sensors(spark, [("a", 1, 9), ("a", 1, 10), ("a", 1, 9)], "int")
    got = late.classify_late(df, "ts", ["seq"], S(10)).orderBy("seq").collect()
    assert [r.status for r in got] == ["on_time", "on_time", "late"]
    assert got[2].watermark_ms == 9_999


def test_windows_and_firings(spark):
    def ends(c):
        return F.unix_seconds(F.col(c)).alias(c)

    final = late.window_with_lateness(classified(spark), ["id"], "temperature", ["seq"], ["seq", "temperature"])
    assert rows_of(final, ends("window_end"), "seq", "temperature") == [(10, 3, 4), (20, 2, 9)]
    for n in (None, 1):
        fired = late.window_firings(
            classified(spark), ["id"], "temperature", ["seq"], ["seq", "temperature"], rows_per_block=n
        )
        assert rows_of(fired, ends("window_end"), "firing_no", "seq", "temperature") == [
            (10, 1, 1, 5), (10, 2, 3, 4), (10, 3, 3, 4), (20, 1, 2, 9)
        ]


def test_largest_row_of_late_windows(spark):
    final = late.window_with_lateness(classified(spark), ["id"], "temperature", ["seq"], ["seq"], pick="max")
    assert rows_of(final, "seq") == [(0,), (2,)]


def test_every_row_has_a_status_per_window(spark):
    df = late.classify_late(rows(spark), "ts", ["seq"], S(10), S(5), S(2), S(4))
    assert df.count() == 2 * len(ARRIVED)
    out = late.late_rows(rows(spark), "ts", ["seq"], S(10), S(5), S(2), S(4))
    all_late = df.groupBy("seq").agg(F.every(F.col("status") == "late").alias("gone")).where("gone")
    assert rows_of(out, "seq") == rows_of(all_late, "seq")


@pytest.mark.parametrize(("size", "slide"), [(15, 10), (4, 4)])
def test_windows_of_a_row_match_spark(spark, size, slide):
    df = late.classify_late(rows(spark), "ts", ["seq"], S(size), S(slide))
    w = F.window("ts", f"{size} seconds", f"{slide} seconds")
    want = rows(spark).select("seq", w.alias("w")).select("seq", "w.start", "w.end")
    assert rows_of(df, "seq", "window_start", "window_end") == rows_of(want)
