"""Queries over event-time windows, rankings and late rows."""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.messages import (
    HEAT_LABEL,
    ITEM_LABEL,
    REPORT_HEADER,
    REPORT_RULE,
    URL_LABEL,
    VISITS_LABEL,
)
from tidemark.functions.timing import epoch_micros, micros, shift
from tidemark.operators import lateness as late
from tidemark.operators import lookup, topn, windows
from tidemark.operators.accumulate import LargestMean, accumulate
from tidemark.plans.catalog import EV, events, own_name, query, table, windows_sql
from tidemark.session import scratch_path
from tidemark.sinks.declared import Sinks
from tidemark.sources.readers import view

HOUR = timedelta(hours=1)
TEN_MINUTES = timedelta(minutes=10)
FIVE_MINUTES = timedelta(minutes=5)
THREE_HOURS = timedelta(hours=3)
MONTH = timedelta(days=30)
TEN_DAYS = timedelta(days=10)

HOURLY = windows_sql("ev", "ts", "1 hour", "10 minutes", 6)
THREE_HOURLY = windows_sql("ev", "ts", "3 hours", "1 hour", 3)
VIEW = "event_type = 'view'"


SLIDING_SQL = f"""
WITH {EV}
SELECT event_type, window_start, window_end, count(*) AS cnt, arg_min(ts, event_id) AS first_ts
FROM {HOURLY} GROUP BY event_type, window_start, window_end
"""


@query(SLIDING_SQL)
def sliding_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    aggs = [windows.count_rows(), windows.first_of(F.col("ts"), F.col("event_id"), "first_ts")]
    return windows.windowed(rows, "ts", HOUR, aggs, TEN_MINUTES, ["event_type"])


@query(f"""
WITH {EV}
SELECT window_start, window_end, CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS pv
FROM {HOURLY} GROUP BY window_start, window_end
""")
def sliding_indicator_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return windows.windowed(rows, "ts", HOUR, [windows.sum_of(windows.indicator(F.expr(VIEW)), "pv")], TEN_MINUTES)


@query(f"""
WITH {EV}
SELECT item_id, window_start, window_end,
  CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS pv
FROM {HOURLY} GROUP BY item_id, window_start, window_end
""")
def sliding_indicator_sum_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [windows.sum_of(windows.indicator(F.expr(VIEW)), "pv")]
    return windows.windowed(events(spark, sf_dir), "ts", HOUR, aggs, TEN_MINUTES, ["item_id"])


@query(f"""
WITH {EV}
SELECT window_start, window_end, count(*) AS pv FROM {THREE_HOURLY}
WHERE event_type = 'view' GROUP BY window_start, window_end
""")
def pv_3h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(VIEW)
    return windows.windowed(rows, "ts", THREE_HOURS, [windows.count_rows("pv")], HOUR)


UV_SQL = f"""
WITH {EV}
SELECT window_start, window_end, count(DISTINCT user_id) AS uv FROM {THREE_HOURLY}
WHERE event_type = 'view' GROUP BY window_start, window_end
"""


@query(UV_SQL)
def uv_3h_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(VIEW)
    return windows.distinct_count(rows, "ts", "user_id", THREE_HOURS, HOUR)


ROW_SQL = """
SELECT event_type, window_start, window_end, event_id, ts, value FROM (
  SELECT *, time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{size}' AS window_end,
    row_number() OVER (
      PARTITION BY event_type, time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01')
      ORDER BY value {direction}, event_id) AS rn
  FROM events) WHERE rn = 1
"""


@query(ROW_SQL.format(size="1 hour", direction="DESC"))
def tumbling_max_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return windows.extreme_row(
        rows, "ts", HOUR, ["event_type"], "value", "event_id", "max", ["event_id", "ts", "value"]
    )


@query(ROW_SQL.format(size="10 minutes", direction="ASC"))
def tumbling_min_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return windows.extreme_row(
        rows, "ts", TEN_MINUTES, ["event_type"], "value", "event_id", "min", ["event_id", "ts", "value"]
    )


@query("""
SELECT o_custkey, window_start, window_end, o_orderkey, o_totalprice, o_orderdate FROM (
  SELECT *, window_start + INTERVAL '30 days' AS window_end, row_number() OVER (
      PARTITION BY o_custkey, window_start ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM (SELECT *, time_bucket(INTERVAL '30 days', o_orderdate, TIMESTAMP '1970-01-01') AS window_start
        FROM orders)) WHERE rn = 1
""")
def customer_max_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.extreme_row(
        table(spark, sf_dir, "orders"), "o_orderdate", MONTH, ["o_custkey"],
        "o_totalprice", "o_orderkey", "max", ["o_orderkey", "o_totalprice", "o_orderdate"],
    )


@query(f"""
SELECT o_custkey, window_start, window_end, count(*) AS orders, round(sum(o_totalprice), 2) AS spend
FROM {windows_sql("orders", "o_orderdate", "30 days", "10 days", 3)}
GROUP BY o_custkey, window_start, window_end
""")
def customer_spend_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    aggs = [windows.count_rows("orders"), windows.sum_of(F.col("o_totalprice"), "spend")]
    out = windows.windowed(rows, "o_orderdate", MONTH, aggs, TEN_DAYS, ["o_custkey"])
    return out.withColumn("spend", F.round("spend", 2))


@query(f"""
WITH sold AS (SELECT l_partkey, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT l_partkey, window_start, window_end, count(*) AS sales
FROM {windows_sql("sold", "o_orderdate", "30 days", "10 days", 3)}
GROUP BY l_partkey, window_start, window_end
""")
def item_sales_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    # A task holds a bounded number of rows; left to their size in bytes, tasks grow with the tables.
    tasks = math.ceil(lines.count() / windows.ROWS_PER_TASK)
    if tasks > 1:
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return windows.windowed(
        sold, "o_orderdate", MONTH, [windows.count_rows("sales")], TEN_DAYS, ["l_partkey"], tasks
    )


def ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the time they came in, up to six seconds after they happened."""
    delay = F.make_dt_interval(secs=F.pmod("event_id", F.lit(7)))
    return table(spark, sf_dir, "events").withColumn("ingest_ts", F.col("ts") + delay)


INGESTED_SQL = "ing AS (SELECT *, ts + (event_id % 7) * INTERVAL '1 second' AS ingest_ts FROM events)"
FIFTEEN = timedelta(seconds=15)


@query(f"""
WITH {INGESTED_SQL}
SELECT event_type, window_start, window_end, round(sum(value), 2) AS total
FROM {windows_sql("ing", "ingest_ts", "15 seconds", "15 seconds", 1)}
GROUP BY event_type, window_start, window_end
""")
def ingest_time_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.windowed(
        ingested(spark, sf_dir), "ingest_ts", FIFTEEN, [windows.sum_of(F.col("value"), "total")],
        keys=["event_type"],
    )
    return out.withColumn("total", F.round("total", 2))


@query(f"""
WITH {INGESTED_SQL}
SELECT event_type, window_start, window_end, round(sum(value), 2) AS total
FROM {windows_sql("ing", "ingest_ts", "15 seconds", "10 seconds", 2)}
WHERE window_end > ingest_ts GROUP BY event_type, window_start, window_end
""")
def ingest_time_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.windowed(
        ingested(spark, sf_dir), "ingest_ts", FIFTEEN, [windows.sum_of(F.col("value"), "total")],
        timedelta(seconds=10), ["event_type"],
    )
    return out.withColumn("total", F.round("total", 2))


HOT_ITEMS_CTE = f"""{EV},
agg AS (
  SELECT item_id, window_end, count(*) AS cnt FROM {HOURLY}
  WHERE event_type = 'view' GROUP BY item_id, window_end),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS row_num FROM agg)
  WHERE row_num <= 5)"""
HOT_ITEMS_SQL = f"WITH {HOT_ITEMS_CTE} SELECT item_id, window_end, cnt, row_num FROM top"


@query(HOT_ITEMS_SQL)
def hot_items_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.hot_keys(events(spark, sf_dir).where(VIEW), "ts", "item_id")


@query(HOT_ITEMS_SQL)
def hot_items_top5_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking as SQL over a view of the windowed counts."""
    rows = events(spark, sf_dir).where(VIEW)
    counts = windows.windowed(rows, "ts", HOUR, [windows.count_rows()], TEN_MINUTES, ["item_id"])
    name = own_name("hourly_items")
    view(counts.select("item_id", "window_end", "cnt"), name, ["item_id", "window_end", "cnt"])
    return spark.sql(topn.top_n_sql(name, "window_end", "cnt", "item_id"))


HOT_URLS_CTE = f"""{EV},
visits AS (
  SELECT ev.ts, coalesce(p.url, '/item/' || coalesce(CAST(ev.item_id AS VARCHAR), '')) AS url
  FROM ev LEFT JOIN pages p ON p.page_id = ev.item_id),
agg AS (
  SELECT url, window_end, count(*) AS cnt
  FROM {windows_sql("visits", "ts", "1 hour", "10 minutes", 6)} GROUP BY url, window_end),
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS row_num FROM agg)
  WHERE row_num <= 5)"""


@query(f"WITH {HOT_URLS_CTE} SELECT url, window_end, cnt, row_num FROM top")
def hot_urls_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits of each url; an item without a page is its own url, so every visit counts."""
    return topn.top_n(url_counts(spark, sf_dir), windows.END, "cnt", "url")


def url_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits per url and window, counted per item before the url texts are attached."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("item_id"), "url", F.col("page_id").alias("position")
    )
    rows = events(spark, sf_dir).select("ts", "item_id")
    counts = windows.windowed(rows, "ts", HOUR, [windows.count_rows()], TEN_MINUTES, ["item_id"])
    named = lookup.first_match(counts.select("item_id", windows.END, "cnt"), pages, "item_id", "position", how="left")
    path = F.concat(F.lit("/item/"), F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    by_url = named.withColumn("url", F.coalesce("url", path)).groupBy("url", windows.END)
    return by_url.agg(F.sum("cnt").alias("cnt"))


def _report_sql(ranked: str, key: str, key_label: str, count_label: str) -> str:
    return f"""
WITH {ranked}
SELECT window_end, '{REPORT_HEADER}' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10)
  || string_agg('Top' || row_num || chr(9) || '{key_label}' || {key} || chr(9)
       || '{count_label}' || cnt || chr(10), '' ORDER BY row_num)
  || chr(10) || '{REPORT_RULE}' || chr(10) AS report
FROM top GROUP BY window_end
"""


@query(_report_sql(HOT_URLS_CTE, "url", URL_LABEL, VISITS_LABEL))
def topn_url_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.report(hot_urls_top5(spark, sf_dir), "url", URL_LABEL, VISITS_LABEL)


@query(_report_sql(HOT_ITEMS_CTE, "item_id", ITEM_LABEL, HEAT_LABEL))
def topn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.report(hot_items_top5(spark, sf_dir), "item_id", ITEM_LABEL, HEAT_LABEL)


@query("""
SELECT o_custkey, round(avg(o_totalprice), 4) AS largest_mean FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS rn FROM orders)
WHERE rn <= 3 GROUP BY o_custkey
""")
def customer_largest_orders_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An accumulator of the user's own: the mean of each customer's three largest orders."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    out = accumulate(rows, ["o_custkey"], ["o_totalprice"], LargestMean(3), "largest_mean", "double")
    return out.withColumn("largest_mean", F.round("largest_mean", 4))


@query(f'SELECT item_id AS "commodityId", window_end AS "windowEnd", cnt, row_num FROM ({HOT_ITEMS_SQL})')
def sink_insert_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking inserted into a declared sink; its key is the window and the rank."""
    sinks = Sinks(spark)
    columns = "commodityId long, windowEnd timestamp_ntz, cnt long, row_num long"
    sinks.declare("top_items", columns, scratch_path(spark, "sink"), mode="upsert")
    ranked = hot_items_top5(spark, sf_dir).select("item_id", "window_end", "cnt", "row_num")
    sinks.insert_into("top_items", ranked)
    sinks.insert_into("top_items", ranked.where("row_num <= 2"))
    return sinks.read("top_items")


# Arrival: events reach us up to 20 minutes after they happened, out of order.
DELAY, LATENESS = timedelta(seconds=120), timedelta(seconds=240)
ARRIVAL = ["arrival", "event_id"]


def with_arrival(rows: DataFrame) -> DataFrame:
    """Events with the order in which they reach us."""
    disorder = F.pmod(F.col("event_id") * 37, F.lit(11)) * micros(timedelta(minutes=2))
    arrival = epoch_micros(F.col("ts")) + disorder
    return rows.select("event_id", "event_type", "ts", "value", arrival.alias("arrival"))


def jittered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_arrival(table(spark, sf_dir, "events"))


LATE_CTE = """arr AS (
  SELECT event_id, event_type, ts, value, epoch_us(ts) // 1000 AS ms,
    epoch_us(ts) + (event_id * 37 % 11) * 120000000 AS arrival FROM events),
seen AS (
  SELECT *, coalesce(max(ms) OVER (ORDER BY arrival, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 120000, -4611686018427387904) AS watermark_ms
  FROM arr)"""


def _status_sql(windowed: str) -> str:
    return f"""SELECT *, CASE WHEN epoch_ms(window_end) - 1 > watermark_ms THEN 'on_time'
    WHEN epoch_ms(window_end) - 1 + 240000 > watermark_ms THEN 'refire' ELSE 'late' END AS status
  FROM {windowed}"""


STATUS_CTE = f"""{LATE_CTE},
status AS ({_status_sql(windows_sql("seen", "ts", "10 minutes", "10 minutes", 1))})"""
SLIDING_STATUS_CTE = f"""{LATE_CTE},
status AS ({_status_sql(windows_sql("seen", "ts", "10 minutes", "5 minutes", 2))})"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.classify_late(
        jittered(spark, sf_dir), "ts", ARRIVAL, TEN_MINUTES, delay=DELAY, lateness=LATENESS
    )


@query(f"""
WITH {STATUS_CTE}
SELECT event_id, watermark_ms, window_start, window_end, status FROM status
""")
def late_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select(
        "event_id", "watermark_ms", "window_start", "window_end", "status"
    )


@query(f"""
WITH {SLIDING_STATUS_CTE}
SELECT event_id, window_start, window_end, status FROM status
""")
def late_status_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late.classify_late(
        jittered(spark, sf_dir), "ts", ARRIVAL, TEN_MINUTES, FIVE_MINUTES, DELAY, LATENESS
    ).select("event_id", "window_start", "window_end", "status")


SIXTEEN_HOURS = timedelta(hours=16)


@query("""
WITH arr AS (
  SELECT event_id, ts + INTERVAL '16 hours' AS ts, epoch_us(ts) + (event_id * 37 % 11) * 120000000 AS arrival
  FROM events),
seen AS (
  SELECT *, coalesce(max(epoch_us(ts) // 1000) OVER (ORDER BY arrival, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1, -4611686018427387904) AS watermark_ms FROM arr)
SELECT event_id, ts, window_end,
  CASE WHEN epoch_ms(window_end) - 1 > watermark_ms THEN 'on_time' ELSE 'late' END AS status
FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end FROM seen)
""")
def shifted_ascending_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times moved by a fixed span, under the watermark for ascending times."""
    rows = jittered(spark, sf_dir).withColumn("ts", shift(F.col("ts"), SIXTEEN_HOURS))
    return late.classify_late(rows, "ts", ARRIVAL, HOUR).select("event_id", "ts", "window_end", "status")


LATE_COLUMNS = "event_id, event_type, ts, value, arrival"


@query(f"WITH {STATUS_CTE} SELECT {LATE_COLUMNS} FROM status WHERE status = 'late'")
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jittered(spark, sf_dir)
    return late.late_rows(rows, "ts", ARRIVAL, TEN_MINUTES, delay=DELAY, lateness=LATENESS)


@query(f"""
WITH {SLIDING_STATUS_CTE}
SELECT {LATE_COLUMNS} FROM status GROUP BY ALL HAVING bool_and(status = 'late')
""")
def late_rows_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jittered(spark, sf_dir)
    return late.late_rows(rows, "ts", ARRIVAL, TEN_MINUTES, FIVE_MINUTES, DELAY, LATENESS)


@query(f"""
WITH {STATUS_CTE}
SELECT event_type, window_start, window_end, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, window_end ORDER BY value, arrival, event_id) AS rn
  FROM status WHERE status <> 'late') WHERE rn = 1
""")
def window_with_lateness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _classified(spark, sf_dir)
    return late.window_with_lateness(rows, ["event_type"], "value", ARRIVAL, ["event_id", "value"])


FIRINGS_SQL = f"""
WITH {STATUS_CTE},
ok AS (SELECT * FROM status WHERE status <> 'late'),
best AS (
  SELECT *, arg_min(struct_pack(event_id := event_id, value := value),
      struct_pack(v := value, a := arrival, e := event_id))
      OVER (PARTITION BY event_type, window_end ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS b,
    lead(status) OVER (PARTITION BY event_type, window_end ORDER BY arrival, event_id) AS next_status
  FROM ok),
fired AS (
  SELECT *, row_number() OVER (PARTITION BY event_type, window_end ORDER BY arrival, event_id) AS firing_no
  FROM best WHERE status = 'refire' OR next_status IS NULL OR next_status = 'refire')
SELECT event_type, window_start, window_end, firing_no, b.event_id AS event_id, b.value AS value FROM fired
"""


@query(FIRINGS_SQL)
def window_firings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = late.with_windows(jittered(spark, sf_dir), "ts", TEN_MINUTES)
    return late.window_firings(
        _classified(spark, sf_dir), ["event_type"], "value", ARRIVAL, ["event_id", "value"],
        unclassified=rows,
    )
