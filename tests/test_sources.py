import datetime as dt

import pytest
from fixtures import rows_of
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import word_rows
from tidemark.functions.timing import clock_text, shift
from tidemark.sources import parsers, readers


def test_words_drop_only_trailing_empties(spark):
    lines = ["a b", "a b  ", " a  b", "", "   "]
    got = {}
    for x in lines:
        df = spark.createDataFrame([(x,)], "value string")
        got[x] = [r.word for r in word_rows(df, "value").collect()]
    assert got == {"a b": ["a", "b"], "a b  ": ["a", "b"], " a  b": ["", "a", "", "b"], "": [""], "   ": []}


def test_csv_records_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("c1,01,Ann,f,95\nc1,02,Bob,m,65\n")
    df = readers.csv_records(spark, str(tmp_path), schemas.STUDENT)
    assert rows_of(df, "name", "score") == [("Ann", 95), ("Bob", 65)]


def test_bad_csv_fails(spark, tmp_path):
    (tmp_path / "s.csv").write_text("c1,01,Ann,f,many\n")
    with pytest.raises(Exception, match="MALFORMED"):
        readers.csv_records(spark, str(tmp_path), schemas.STUDENT).collect()


@pytest.mark.parametrize("bad", ["s3,many,1", "s3,1.0"])
def test_bad_csv_fails_if_one_column_is_used(spark, tmp_path, bad):
    (tmp_path / "s.csv").write_text(f"s1,20.5,1\n{bad}\n")
    readers.csv_table(spark, "bad_sensors", str(tmp_path), schemas.SENSOR)
    with pytest.raises(Exception, match="MALFORMED"):
        spark.sql("SELECT id, count(*) AS cnt FROM bad_sensors GROUP BY id").collect()
    stream = readers.csv_stream(spark, str(tmp_path), schemas.SENSOR).select("id")
    q = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    with pytest.raises(Exception):
        q.awaitTermination()


def test_csv_table_is_seen_by_sql(spark, tmp_path):
    (tmp_path / "s.csv").write_text("s1,20.5,1\ns1,21.5,2\ns2,3.0,3\n")
    readers.csv_table(spark, "sensors", str(tmp_path), schemas.SENSOR)
    got = rows_of(spark.sql("SELECT id, count(*) AS cnt FROM sensors GROUP BY id"))
    assert got == [("s1", 2), ("s2", 1)]
    assert rows_of(readers.table(spark, "sensors"), "id") == [("s1",), ("s1",), ("s2",)]


def test_view_names_columns(spark):
    readers.view(readers.rows_of(spark, [(1, "x")], "a int, b string"), "named", ["n", "t"])
    assert spark.sql("SELECT n, t FROM named").first() == (1, "x")


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_parse_delimited(spark):
    df = parsers.parse_delimited(lines(spark, "7,12,3,pv,1511658000"), schemas.BEHAVIOR)
    assert df.first() == (7, 12, 3, "pv", 1511658000)


@pytest.mark.parametrize("sep", ["|", ".", "||", "\\E"])
def test_separator_is_taken_as_it_stands(spark, sep):
    df = parsers.parse_delimited(lines(spark, sep.join("123")), "a int, b int, c string", sep=sep)
    assert df.first() == (1, 2, "3")


BAD = ["7,12,3", "seven,12,3,pv,1511658000", "7, 12 ,3,pv,1511658000"]


@pytest.mark.parametrize("bad", BAD)
def test_bad_line_fails(spark, bad):
    with pytest.raises(Exception):
        parsers.parse_delimited(lines(spark, bad), schemas.BEHAVIOR).collect()


@pytest.mark.parametrize("bad", BAD)
def test_tolerant_parse_gives_nulls(spark, bad):
    row = parsers.parse_delimited(lines(spark, bad), schemas.BEHAVIOR, tolerant=True).first()
    assert None in tuple(row)


def test_access_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /images/a.png"
    got = parsers.parse_access_log(lines(spark, line)).first()
    ms = int(dt.datetime(2015, 5, 17, 10, 5, 3, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert got == ("83.149.9.216", ms, "+0000", "GET", "/images/a.png")


def test_access_log_with_bad_time_fails(spark):
    with pytest.raises(Exception):
        parsers.parse_access_log(lines(spark, "1.1.1.1 - - yesterday +0000 GET /")).collect()


def test_shift_and_clock(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 10:00:00' AS ts")
    got = df.select(clock_text(shift(F.col("ts"), dt.timedelta(hours=16)))).first()[0]
    assert got == "2024-01-02 02:00:00"


def test_event_table_marks_zoneless_time(spark, tmp_path):
    spark.sql("SELECT timestamp_ntz'2024-01-01 10:00:00' AS ts, 1 AS v").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp_ntz, v int").parquet(str(tmp_path / "in"))
    marked = readers.event_table(stream, "at", dt.timedelta(seconds=2), {"ts": "at"})
    assert marked.isStreaming and marked.schema["at"].dataType.simpleString() == "timestamp"


def test_text_and_csv_streams(spark, tmp_path):
    (tmp_path / "a.csv").write_text("s1,20,1\ns2,30,2\n")
    text = readers.text_stream(spark, str(tmp_path), 1)
    csv = readers.csv_stream(spark, str(tmp_path), schemas.SENSOR_INT, 1)
    for stream, name in ((text, "t_out"), (csv, "c_out")):
        q = stream.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination()
    assert rows_of(spark.table("t_out")) == [("s1,20,1",), ("s2,30,2",)]
    assert rows_of(spark.table("c_out")) == [("s1", 20, 1), ("s2", 30, 2)]
