"""Queries without a time window."""

from __future__ import annotations

import re
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import text_lines
from tidemark.operators import aggregates, keyed, lookup
from tidemark.operators.counts import sliding_count, tumbling_count
from tidemark.operators.setup import map_with_setup
from tidemark.plans.catalog import EV, events, own_name, query, table
from tidemark.schemas import BEHAVIOR
from tidemark.session import scratch_path
from tidemark.sinks.declared import Sinks
from tidemark.sinks.text import write_text
from tidemark.sinks.upsert import latest_by_key
from tidemark.sources import parsers, readers

JUMP = 100.0
RISE_SPAN = timedelta(hours=5)


@query("""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
words AS (
  SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word FROM lines
  WHERE line = '' OR rtrim(line, ' ') <> '')
SELECT word, count(*) AS cnt FROM words GROUP BY word
""")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    lines = docs.select(F.explode(text_lines(F.col("text"))).alias("value"))
    return aggregates.word_count(lines)


RUNNING_SQL = """
SELECT event_id, event_type,
  count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cnt
FROM events
"""


@query(RUNNING_SQL)
def running_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return keyed.running_sum(rows, "event_type", ["event_id"])


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 4 AND p_name LIKE 'h%'")
def string_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return aggregates.long_with_prefix(parts, "p_name", 4, "h")


CUSTOMER = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
EXTREME_SQL = """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal {direction}, c_custkey) AS rn
  FROM customer) WHERE rn = 1
"""


@query(EXTREME_SQL.format(direction="ASC"))
def row_of_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER)
    return aggregates.row_of(rows, "c_acctbal", "c_custkey", "min", ["c_mktsegment"])


@query(EXTREME_SQL.format(direction="DESC"))
def row_of_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER)
    return aggregates.row_of(rows, "c_acctbal", "c_custkey", "max", ["c_mktsegment"])


@query("""
WITH c AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS low,
    row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS high,
    row_number() OVER (ORDER BY c_acctbal, c_custkey) AS low_all,
    row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS high_all FROM c)
SELECT false AS overall, 'min' AS pick, c_custkey, c_name, c_acctbal, c_mktsegment FROM ranked WHERE low = 1
UNION ALL
SELECT false, 'max', c_custkey, c_name, c_acctbal, c_mktsegment FROM ranked WHERE high = 1
UNION ALL
SELECT true, 'min', c_custkey, c_name, c_acctbal, c_mktsegment FROM ranked WHERE low_all = 1
UNION ALL
SELECT true, 'max', c_custkey, c_name, c_acctbal, c_mktsegment FROM ranked WHERE high_all = 1
""")
def extreme_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(*CUSTOMER)
    return aggregates.extremes(rows, "c_acctbal", "c_custkey", "c_mktsegment")


@query("""
SELECT count(*) AS total,
  count(*) FILTER (c_mktsegment = 'FURNITURE') AS furniture,
  count(*) FILTER (c_mktsegment = 'MACHINERY') AS machinery
FROM customer
""")
def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return aggregates.counts_where(
        table(spark, sf_dir, "customer"),
        furniture=segment == "FURNITURE",
        machinery=segment == "MACHINERY",
    )


@query("""
SELECT c_custkey, n_name, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nations = nations.withColumn("position", F.col("n_nationkey"))
    found = lookup.first_match(customers, nations, "n_nationkey", "position")
    return found.select("c_custkey", "n_name", "c_acctbal")


WEIGHTS = [("view", 1), ("click", 3), ("purchase", 20)]


@query(f"""
SELECT event_type, weight, count(*) AS cnt FROM events
LEFT JOIN (VALUES {", ".join(map(str, WEIGHTS))}) w(kind, weight) ON kind = event_type GROUP BY event_type, weight
""")
def literal_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with a weight from literal rows; kinds without one have none."""
    weights = readers.rows_of(spark, [(k, w, i) for i, (k, w) in enumerate(WEIGHTS)], "event_type string, weight int, position int")
    counts = aggregates.group_count(table(spark, sf_dir, "events"), "event_type")
    return lookup.first_match(counts, weights, "event_type", "position", how="left")


@query(f"WITH {EV} SELECT event_id, item_id FROM ev")
def item_with_setup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items found by a pattern that each task compiles once."""
    def find(pattern: re.Pattern, rows: pd.DataFrame) -> pd.DataFrame:
        return rows[["event_id"]].assign(item_id=rows["props"].str.extract(pattern, expand=False).astype("Int64"))

    rows = table(spark, sf_dir, "events").select("event_id", "props")
    return map_with_setup(rows, lambda: re.compile("([0-9]+)"), find, "event_id long, item_id long")


@query("SELECT count(*) AS cnt FROM part")
def accumulated_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, seen = aggregates.counted(table(spark, sf_dir, "part"))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(seen.get["count"],)], "cnt long")


GROUP_COUNT_SQL = "SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type"


@query(GROUP_COUNT_SQL)
def group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.group_count(table(spark, sf_dir, "events"), "event_type")


@query(GROUP_COUNT_SQL)
def group_count_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = own_name("input_table")
    readers.view(table(spark, sf_dir, "events"), name)
    return spark.sql(aggregates.GROUP_COUNT_SQL.format(key="event_type", view=name))


@query("SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS cnt FROM events GROUP BY user_id")
def csv_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count over delimited files that are declared as a table."""
    path = scratch_path(spark, "csv-table")
    rows = table(spark, sf_dir, "events")
    rows.select("user_id", "value", F.unix_seconds(F.col("ts").cast("timestamp"))).write.csv(path)
    name = own_name("sensor_table")
    readers.csv_table(spark, name, path, "id string, temperature double, ts_s long")
    return spark.sql(aggregates.GROUP_COUNT_SQL.format(key="id", view=name))


@query("SELECT event_type, count(*) AS cnt FROM events WHERE value > 10 GROUP BY event_type")
def named_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count over a table that is read by its name."""
    name = own_name("events_by_name")
    readers.view(table(spark, sf_dir, "events"), name)
    return aggregates.group_count(readers.table(spark, name).where("value > 10"), "event_type")


@query("SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS cnt FROM events GROUP BY user_id")
def sink_insert_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count inserted into a declared sink twice: of the first events, then of all."""
    sinks = Sinks(spark)
    sinks.declare("user_counts", "id string, cnt long", scratch_path(spark, "sink"), mode="upsert")
    rows = table(spark, sf_dir, "events").select("event_id", F.col("user_id").cast("string").alias("user"))
    for part in (rows.where("event_id < 1000"), rows):
        sinks.insert_into("user_counts", aggregates.group_count(part, "user"))
    return sinks.read("user_counts")


CHANGELOG_SQL = """
WITH r AS (
  SELECT event_id, event_type,
    count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n
  FROM events)
SELECT event_id, event_type, '+' AS op, n AS cnt FROM r
UNION ALL
SELECT event_id, event_type, '-' AS op, n - 1 AS cnt FROM r WHERE n > 1
"""


@query(CHANGELOG_SQL)
def retract_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.changelog(table(spark, sf_dir, "events"), "event_type", ["event_id"])


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delimited lines: user, item, type, behavior, epoch seconds."""
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    line = F.concat_ws(",", "user_id", "item_id", F.length("event_type"), "event_type", seconds)
    return events(spark, sf_dir).select(line.alias("value"))


@query(f"""
WITH {EV}
SELECT CAST(user_id AS INTEGER) AS user_id, CAST(item_id AS INTEGER) AS item_id,
  CAST(length(event_type) AS INTEGER) AS type_id, event_type AS behavior,
  epoch_us(ts) // 1000000 AS ts_s FROM ev
""")
def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.parse_delimited(behavior_lines(spark, sf_dir), BEHAVIOR)


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as access-log lines."""
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256))),
        F.lit("- -"),
        F.date_format("ts", parsers.ACCESS_TIME),
        F.lit("+0000 GET"),
        F.concat(F.lit("/item/"), "item_id"),
    )
    return events(spark, sf_dir).select("event_id", line.alias("value"))


@query(f"""
WITH {EV}
SELECT event_id, '10.0.0.' || (user_id % 256) AS ip, epoch_ms(date_trunc('second', ts)) AS ts_ms,
  '+0000' AS timezone, 'GET' AS way, '/item/' || item_id AS url FROM ev
""")
def parse_access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsers.parse_access_log(access_lines(spark, sf_dir))


@query("SELECT p_name AS value, count(*) AS cnt FROM part WHERE length(p_name) > 4 AND p_name LIKE 'h%' GROUP BY p_name")
def text_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered names written as four text files and read back."""
    path = scratch_path(spark, "names")
    names = aggregates.long_with_prefix(table(spark, sf_dir, "part").select("p_name"), "p_name", 4, "h")
    write_text(names, path, files=4)
    return aggregates.group_count(readers.text_lines_of(spark, path), "value")


@query("""
WITH n AS (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
SELECT user_id, (rn - 1) // 5 + 1 AS block_no, round(sum(value) / 5, 4) AS mean_value
FROM n GROUP BY user_id, (rn - 1) // 5 HAVING count(*) = 5
""")
def count_window_mean5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    mean = F.round(F.sum("value") / 5, 4)
    return tumbling_count(rows, "user_id", ["event_id"], 5, mean_value=mean)


COUNT_5_2_SQL = """
WITH n AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
    sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS 4 PRECEDING) AS s FROM events)
SELECT user_id, rn AS fired_at, round(s, 2) AS sum_value FROM n WHERE rn % 2 = 0
"""


@query(COUNT_5_2_SQL)
def count_window_5_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    total = F.round(F.sum("value"), 2)
    return sliding_count(rows, "user_id", ["event_id"], 5, 2, sum_value=total)


JUMP_SQL = f"""
WITH p AS (
  SELECT event_id, user_id, ts, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
  FROM events)
SELECT event_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') || '--' || user_id || '的温度连续变化超过了{JUMP:g}°' AS message,
  previous, value AS current
FROM p WHERE abs(value - previous) > {JUMP}
"""


@query(JUMP_SQL)
def jump_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return keyed.jump_alert(rows, "user_id", "value", "ts", ["event_id"], JUMP)


RISE_SQL = """
WITH p AS (
  SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms, value,
    lag(value) OVER w AS prev FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000, event_id)),
r AS (
  SELECT *, sum(CASE WHEN value < prev THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS run FROM p),
s AS (
  SELECT *, sum(CASE WHEN value > prev THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id, run ORDER BY ts_ms, event_id ROWS UNBOUNDED PRECEDING) AS rises,
    min(ts_ms) OVER (PARTITION BY user_id, run) AS run_start_ms FROM r),
k AS (
  SELECT user_id, event_id, ts_ms, run, run_start_ms,
    max(struct_pack(run := run, rises := rises)) OVER (PARTITION BY user_id ORDER BY ts_ms
      RANGE BETWEEN CURRENT ROW AND 18000000 FOLLOWING) AS then_state FROM s)
SELECT user_id, event_id AS seq, ts_ms + 18000000 AS timer_ms, run_start_ms,
  CAST(then_state.rises AS BIGINT) AS rises,
  (ts_ms + 18000000) || ' ,Fire! since ' || run_start_ms || ' ('
    || strftime(make_timestamp(run_start_ms * 1000), '%Y-%m-%d %H:%M:%S') || ') ' || user_id
    || '''s temperature keep increasing for ' || CAST(then_state.rises AS BIGINT) || ' times' AS message
FROM k WHERE then_state.run = run AND then_state.rises >= 5
"""


@query(RISE_SQL)
def sustained_rise_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return keyed.sustained_rise_alert(rows, "user_id", "value", "ts", "event_id", RISE_SPAN)


@query(RISE_SQL + " AND ts_ms + 18000000 <= (SELECT max(epoch_us(ts) // 1000) FROM events)")
def sustained_rise_alert_hold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events")
    return keyed.sustained_rise_alert(
        rows, "user_id", "value", "ts", "event_id", RISE_SPAN, at_end="hold"
    )


UPSERT_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
"""


@query(UPSERT_SQL)
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return latest_by_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])
