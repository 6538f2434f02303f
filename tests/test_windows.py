from datetime import timedelta

import pytest
from fixtures import SENSOR_INT, rows_of, sensors, skewed
from pyspark.sql import functions as F

from tidemark.functions.messages import HEAT_LABEL, ITEM_LABEL, REPORT_HEADER, REPORT_RULE
from tidemark.functions.timing import interval_text
from tidemark.operators import topn, windows

S = lambda n: timedelta(seconds=n)


def seconds(c):
    return F.unix_seconds(F.col(c)).alias(c)


def extreme(spark, size, pick):
    df = windows.extreme_row(
        sensors(spark, SENSOR_INT, "int"), "ts", S(size), ["id"], "temperature", "seq", pick,
        ["temperature", "ts_s"],
    )
    return rows_of(df, "id", "temperature", "ts_s")


def test_tumbling_max_row(spark):
    base = 1547718000
    assert extreme(spark, 5, "max") == sorted([
        ("sensor_1", 25, base + 199), ("sensor_1", 29, base + 200), ("sensor_1", 33, base + 205),
        ("sensor_1", 25, base + 230), ("sensor_2", 26, base + 199), ("sensor_3", 28, base + 199),
    ])


def test_tumbling_min_row(spark):
    base = 1547718000
    assert extreme(spark, 10, "min") == sorted([
        ("sensor_1", 25, base + 199), ("sensor_1", 22, base + 201), ("sensor_1", 25, base + 230),
        ("sensor_2", 26, base + 199), ("sensor_3", 28, base + 199),
    ])


def test_ties_go_to_the_first_arrival(spark):
    df = sensors(spark, [("a", 5, 1), ("a", 5, 2), ("a", 1, 3), ("a", 1, 4)], "int")
    for pick, seq in (("max", 0), ("min", 2)):
        got = windows.extreme_row(df, "ts", S(10), ["id"], "temperature", "seq", pick, ["seq"])
        assert got.first().seq == seq


def aggs():
    return [
        windows.count_rows(),
        windows.sum_of(F.col("v"), "total"),
        windows.first_of(F.col("ms"), F.col("seq"), "first_ms"),
    ]


@pytest.mark.parametrize(("size", "slide"), [(30, 10), (3, 1), (20, 20), (15, 10)])
def test_panes_equal_plain_windows(spark, size, slide):
    df = skewed(spark)
    got = windows.windowed(df, "ts", S(size), aggs(), S(slide), ["k"])
    w = F.window("ts", interval_text(S(size)), interval_text(S(slide)))
    want = df.groupBy("k", w.alias("w")).agg(
        F.count("*"), F.sum("v"), F.min_by("ms", "seq")
    ).select("k", "w.start", "w.end", "count(1)", "sum(v)", "min_by(ms, seq)")
    assert rows_of(got) == rows_of(want)


def test_ad_clicks_fall_in_six_windows(spark):
    rows = [("north" if i % 5 else "south", 1, 1511658000 + 7 * i) for i in range(143)]
    got = windows.windowed(
        sensors(spark, rows, "int"), "ts", timedelta(hours=1), [windows.count_rows()],
        timedelta(minutes=10), ["id"],
    )
    assert got.agg(F.sum("cnt")).first()[0] == 143 * 6


def test_indicator_keeps_windows_without_a_match(spark):
    df = sensors(spark, [("pv", 1, 1), ("buy", 1, 12), ("buy", 1, 13)], "int")
    pv = windows.sum_of(windows.indicator(F.col("id") == "pv"), "pv")
    assert rows_of(windows.windowed(df, "ts", S(10), [pv]), seconds("window_start"), "pv") == [(0, 1), (10, 0)]
    only = windows.windowed(df.where("id = 'pv'"), "ts", S(10), [windows.count_rows("pv")])
    assert only.count() == 1


@pytest.mark.parametrize("slide", [None, 10])
def test_distinct_count(spark, slide):
    df = skewed(spark)
    step = S(slide) if slide else None
    got = windows.distinct_count(df, "ts", "v", S(30), step)
    w = F.window("ts", "30 seconds", f"{slide or 30} seconds")
    want = df.groupBy(w.alias("w")).agg(F.count_distinct("v").alias("uv")).select("w.start", "w.end", "uv")
    assert rows_of(got) == rows_of(want)


def clicks(spark):
    rows = [(i, 1, 100 + n) for i, times in ((1, 3), (2, 3), (3, 1), (4, 2), (5, 1), (6, 1)) for n in range(times)]
    rows += [(9, 1, 4000), (8, 1, 4001), (8, 1, 4002)]
    return sensors(spark, [(str(i), t, s) for i, t, s in rows], "int").withColumn("item", F.col("id").cast("int"))


def test_top_n_breaks_ties_and_takes_small_windows(spark):
    hour = timedelta(hours=1)
    df = topn.hot_keys(clicks(spark), "ts", "item", hour, hour)
    got = rows_of(df, seconds("window_end"), "row_num", "item", "cnt")
    assert got == [(3600, 1, 1, 3), (3600, 2, 2, 3), (3600, 3, 4, 2), (3600, 4, 3, 1), (3600, 5, 5, 1),
                   (7200, 1, 8, 2), (7200, 2, 9, 1)]
    counts = windows.windowed(clicks(spark), "ts", hour, [windows.count_rows()], keys=["item"])
    counts.select("item", "window_end", "cnt").createOrReplaceTempView("hourly")
    sql = spark.sql(topn.top_n_sql("hourly", "window_end", "cnt", "item"))
    assert rows_of(sql, seconds("window_end"), "row_num", "item", "cnt") == got


def test_report(spark):
    hour = timedelta(hours=1)
    ranked = topn.hot_keys(clicks(spark), "ts", "item", hour, hour)
    last = topn.report(ranked, "item", ITEM_LABEL, HEAT_LABEL).orderBy(F.desc("window_end")).first().report
    assert last == (
        f"{REPORT_HEADER}1970-01-01 02:00:00\n"
        f"Top1\t{ITEM_LABEL}8\t{HEAT_LABEL}2\nTop2\t{ITEM_LABEL}9\t{HEAT_LABEL}1\n"
        f"\n{REPORT_RULE}\n"
    )


def test_slide_is_not_longer_than_the_size(spark):
    with pytest.raises(ValueError):
        windows.windowed(skewed(spark), "ts", S(5), aggs(), S(20))


def test_every_visit_counts_in_the_url_ranking(spark):
    """Also where an item has no page, as half of the items of the smallest tables."""
    from tidemark.plans import windows as plans

    sf_dir = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    counts = plans.url_counts(spark, sf_dir)
    assert counts.agg(F.sum("cnt")).first()[0] == events.count() * 6
    assert counts.where("url LIKE '/item/%'").count() > 0


def test_item_sales_hold_a_bounded_number_of_rows_in_a_task(spark, monkeypatch):
    """Left to their size in bytes, all rows of a small table are one task."""
    from compare import check, connect

    from tidemark.plans import ORACLE, QUERIES

    monkeypatch.setattr(windows, "ROWS_PER_TASK", 500, raising=False)
    got = QUERIES["item_sales_sliding"](spark, "/root/testdata/sf0.001")
    assert got.rdd.getNumPartitions() == 12  # of 6,000 lines
    check(got, connect("/root/testdata/sf0.001"), ORACLE["item_sales_sliding"])
