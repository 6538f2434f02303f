"""Texts of alerts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.timing import clock_text, from_millis

# Wording of the reports and alerts.
REPORT_HEADER = "窗口的结束时间："
ITEM_LABEL = "商品ID="
HEAT_LABEL = "热门度="
URL_LABEL = "url="
VISITS_LABEL = "访问次数="
REPORT_RULE = "===================="
JUMP_TEXT = "的温度连续变化超过了"
DEGREE = "°"
JUMP_MARK = "--"
RISE_FIRED, RISE_FROM, RISE_TO = " ,Fire! since ", " (", ") "
RISE_TEXT, RISE_TIMES = "'s temperature keep increasing for ", " times"


def jump_message(ts: Column, key: Column, threshold: float) -> Column:
    return F.concat(
        clock_text(ts), F.lit(JUMP_MARK), key.cast("string"), F.lit(f"{JUMP_TEXT}{threshold:g}{DEGREE}")
    )


def rise_message(timer_ms: Column, start_ms: Column, key: Column, rises: Column) -> Column:
    return F.concat(
        timer_ms.cast("string"),
        F.lit(RISE_FIRED),
        start_ms.cast("string"),
        F.lit(RISE_FROM),
        clock_text(from_millis(start_ms)),
        F.lit(RISE_TO),
        key.cast("string"),
        F.lit(RISE_TEXT),
        rises.cast("string"),
        F.lit(RISE_TIMES),
    )
