import pytest
from fixtures import NAMES, SENSOR_AVG, SENSOR_INT, SENSOR_STATE, WORD_LINES, rows_of, sensors
from datetime import timedelta
from pyspark.sql import functions as F

from tidemark.operators import aggregates, keyed, lookup
from tidemark.operators.counts import sliding_count, tumbling_count

BASE = 1547718000


def lines(spark):
    return spark.createDataFrame([(x,) for x in WORD_LINES], "value string")


def test_word_count(spark):
    got = rows_of(aggregates.word_count(lines(spark)))
    assert got == [("blue", 1), ("fox", 4), ("kite", 2), ("over", 1), ("red", 3)]


def test_running_word_count_gives_one_row_per_word(spark):
    data = [(i, w) for i, w in enumerate(" ".join(WORD_LINES).split(" "))]
    df = spark.createDataFrame(data, "seq long, word string")
    got = {r.seq: r.cnt for r in keyed.running_sum(df, "word", ["seq"]).collect()}
    assert len(got) == 11 and got[0] == 1 and got[3] == 1 and got[7] == 3 and got[10] == 4


def test_name_filter_and_counter(spark):
    names = spark.createDataFrame([(n,) for n in NAMES], "value string")
    got = rows_of(aggregates.long_with_prefix(names, "value", 4, "h"))
    assert got == [("harrier",), ("heron",), ("hoopoe",)]
    passed, seen = aggregates.counted(names)
    passed.collect()
    assert seen.get["count"] == 7


PEOPLE = "id int, name string"
SCORES = "id int, course string, score int"


@pytest.mark.parametrize("cap", [500_000, 1])
def test_first_match(spark, monkeypatch, cap):
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", cap)
    people = spark.createDataFrame(
        [(4, "Wren", 0), (7, "Oda", 1), (9, "Pim", 2), (4, "Late", 3)], PEOPLE + ", position int"
    )
    scores = spark.createDataFrame(
        [(4, "sail", 11), (7, "row", 52), (9, "dive", 33), (9, "row", 47), (9, "sail", 8)], SCORES
    )
    got = lookup.first_match(scores, people, "id", "position").select("name", "course", "score")
    assert rows_of(got) == [
        ("Oda", "row", 52), ("Pim", "dive", 33), ("Pim", "row", 47), ("Pim", "sail", 8), ("Wren", "sail", 11)
    ]


def test_first_match_miss(spark):
    people = spark.createDataFrame([(1, "Una", 0)], PEOPLE + ", position int")
    scores = spark.createDataFrame([(1, "x", 90), (9, "y", 1)], SCORES)
    with pytest.raises(Exception, match="no match for id 9"):
        lookup.first_match(scores, people, "id", "position").collect()
    assert lookup.first_match(scores, people, "id", "position", "inner").count() == 1
    assert rows_of(lookup.first_match(scores, people, "id", "position", "left"), "id", "name") == [
        (1, "Una"), (9, None)
    ]


def students(spark):
    rows = [(10, "Ash", "m", 41), (11, "Bix", "f", 17), (12, "Cob", "m", 12), (13, "Dot", "f", 73), (14, "Elm", "m", 12)]
    return spark.createDataFrame(rows, "no int, name string, gender string, score int")


def test_counts_and_extremes(spark):
    df = students(spark)
    counts = aggregates.counts_where(df, m=F.col("gender") == "m", f=F.col("gender") == "f")
    assert counts.first() == (5, 3, 2)
    got = rows_of(aggregates.extremes(df, "score", "no", "gender"), "overall", "pick", "gender", "name")
    assert got == sorted([
        (False, "min", "m", "Cob"), (False, "max", "m", "Ash"), (False, "min", "f", "Bix"),
        (False, "max", "f", "Dot"), (True, "min", "m", "Cob"), (True, "max", "f", "Dot"),
    ])
    assert aggregates.row_of(df, "score", "no", "max").first()["name"] == "Dot"
    assert aggregates.row_of(df, "score", "no", "min").first()["name"] == "Cob"


def test_group_count_and_changelog(spark):
    rows = [("sensor_1", 0.0, 0)] + [("sensor_2", 0.0, 0), ("sensor_3", 0.0, 0)] + [("sensor_1", 0.0, 0)] * 11
    df = sensors(spark, rows)
    assert rows_of(aggregates.group_count(df, "id")) == [("sensor_1", 12), ("sensor_2", 1), ("sensor_3", 1)]
    log = keyed.changelog(df, "id", ["seq"])
    assert log.count() == 25
    assert rows_of(aggregates.group_count(log, "op")) == [("+", 14), ("-", 11)]
    last = log.where("id = 'sensor_1'").orderBy(F.desc("seq"), F.desc("cnt")).first()
    assert (last.op, last.cnt) == ("+", 12)


def test_count_window_mean(spark):
    mean = F.round(F.sum("temperature") / 5, 2)
    got = tumbling_count(sensors(spark, SENSOR_AVG), "id", ["seq"], 5, mean=mean)
    assert rows_of(got, "block_no", "mean") == [(1, 25.16), (2, 29.8), (3, 27.7)]


def test_count_window_5_2(spark):
    df = sensors(spark, SENSOR_INT, "int")
    got = sliding_count(df, "id", ["seq"], 5, 2, total=F.sum("temperature"))
    assert rows_of(got) == [
        ("sensor_1", f, s) for f, s in zip(range(2, 13, 2), [54, 99, 124, 136, 145, 139])
    ]


def test_slide_longer_than_size_skips_rows(spark):
    df = spark.createDataFrame([(i, "a", i) for i in range(1, 8)], "seq long, k string, v int")
    got = sliding_count(df, "k", ["seq"], 1, 3, total=F.sum("v"))
    assert rows_of(got) == [("a", 3, 3), ("a", 6, 6)]


def test_jump_alert(spark):
    got = keyed.jump_alert(sensors(spark, SENSOR_STATE), "id", "temperature", "ts", ["seq"], 10)
    assert rows_of(got, "previous", "current") == [(12.2, 24.9), (28.5, 12.2)]
    texts = [r.message for r in got.orderBy("seq").collect()]
    assert texts[0] == "2019-01-17 09:43:21--sensor_1的温度连续变化超过了10°"


RISES = [(206, 5), (207, 6), (208, 7), (209, 8), (210, 9)]


def test_sustained_rise(spark):
    def run(at_end):
        df = keyed.sustained_rise_alert(
            sensors(spark, SENSOR_STATE), "id", "temperature", "ts", "seq", timedelta(seconds=5), at_end=at_end
        )
        return [(r.timer_ms // 1000 - BASE, r.rises) for r in df.orderBy("timer_ms").collect()], df

    held, df = run("hold")
    assert held == RISES
    assert {r.run_start_ms for r in df.collect()} == {(BASE + 201) * 1000}
    assert run("flush")[0] == RISES + [(t, 9) for t in range(211, 216)]


def test_map_with_setup(spark):
    from tidemark.operators.setup import map_with_setup

    df = spark.range(5).repartition(2)
    got = map_with_setup(
        df, lambda: {"add": 10}, lambda opened, pdf: pdf.assign(id=pdf["id"] + opened["add"]), "id long"
    )
    assert rows_of(got) == [(i,) for i in range(10, 15)]
