"""The physical plans must suit large inputs."""

import re

import pytest
from conftest import DATA

from tidemark.plans import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["pv_3h_1h", "uv_3h_1h", "sliding_indicator_sum", "hot_items_top5"])
def test_no_single_task_exchange(spark, name):
    assert "SinglePartition" not in plan(QUERIES[name](spark, DATA))


def test_only_block_maxima_meet_in_one_task(spark, monkeypatch):
    """Every single-task exchange of the late-row query sits on an aggregate by block, from two blocks on."""
    monkeypatch.setattr("tidemark.operators.lateness.ROWS_PER_BLOCK", 3000)
    lines = plan(QUERIES["late_status"](spark, DATA)).splitlines()
    singles = [i for i, x in enumerate(lines) if "SinglePartition" in x]
    assert singles
    for i in singles:
        assert re.search(r"HashAggregate\(keys=\[.*__block", lines[i + 1])


@pytest.mark.parametrize("name", ["hot_items_top5", "sliding_count_by_key", "uv_3h_1h", "running_word_count"])
def test_scans_read_needed_columns(spark, name):
    schema = re.search(r"ReadSchema: (struct<.*?>)", plan(QUERIES[name](spark, DATA))).group(1)
    assert schema.count(":") <= 3


def test_filter_reaches_the_scan(spark):
    assert "EqualTo(event_type,view)" in plan(QUERIES["pv_3h_1h"](spark, DATA))


def test_ranking_is_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["hot_items_top5"](spark, DATA))


def test_keyed_replay_has_one_shuffle(spark):
    for name in ("running_word_count", "count_window_5_2", "jump_alert", "sustained_rise_alert"):
        assert plan(QUERIES[name](spark, DATA)).count("Exchange hashpartitioning") == 1


def test_no_python_in_query_plans(spark):
    for name, query in QUERIES.items():
        if not name.startswith("stream_") and name not in ("item_with_setup", "customer_largest_orders_mean"):
            assert "Python" not in plan(query(spark, DATA)), name
