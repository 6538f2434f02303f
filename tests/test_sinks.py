import glob

from fixtures import NAMES, rows_of

from tidemark.sinks import jdbc, text
from tidemark.sinks.upsert import latest_by_key, read_upserted, upsert_folder
from tidemark.sources.readers import text_lines_of

ORDERS = "order_id int, price int, seq int"


def orders(spark, *rows):
    return spark.createDataFrame(list(rows), ORDERS)


def test_text_replaces_and_counts_files(spark, tmp_path):
    path = str(tmp_path / "names")
    names = spark.createDataFrame([(n,) for n in NAMES], "value string")
    text.write_text(names, path)
    text.write_text(names, path, files=4)
    assert len(glob.glob(f"{path}/part-*")) == 4
    assert sorted(r[0] for r in rows_of(text_lines_of(spark, path))) == sorted(NAMES)


def test_print_has_a_label(spark, capsys):
    text.print_rows(orders(spark, (1, 5, 1)), "warning")
    assert "warning" in capsys.readouterr().out


def test_upsert_keeps_the_newest_row(spark, tmp_path):
    path = str(tmp_path / "orders")
    write = upsert_folder(path, ["order_id"], ["seq"])
    write(orders(spark, (1, 10, 1), (1, 11, 2), (2, 20, 3)), 0)
    later = orders(spark, (1, 5, 4), (3, 30, 5))
    write(later, 1)
    want = [(1, 5, 4), (2, 20, 3), (3, 30, 5)]
    assert rows_of(read_upserted(spark, path, ["order_id"], ["seq"])) == want
    write(later, 1)  # the same batch again
    assert rows_of(read_upserted(spark, path, ["order_id"], ["seq"])) == want


def test_upsert_folder_is_compacted(spark, tmp_path):
    path = str(tmp_path / "orders")
    write = upsert_folder(path, ["order_id"], ["seq"], compact_every=3)
    for i in range(8):
        for _ in range(2):
            write(orders(spark, (i % 4, i, i), (9, i, i)), i)
    assert len(glob.glob(f"{path}/log/batch_id=*")) == 2 and len(glob.glob(f"{path}/tables/*")) == 1
    want = [(0, 4, 4), (1, 5, 5), (2, 6, 6), (3, 7, 7), (9, 7, 7)]
    assert rows_of(read_upserted(spark, path, ["order_id"], ["seq"])) == want
    write(orders(spark, (0, 99, 99)), 2)  # an old batch again
    assert rows_of(read_upserted(spark, path, ["order_id"], ["seq"])) == want


def test_print_stream(spark, tmp_path):
    stream = spark.readStream.schema("value string").text(str(tmp_path))
    (tmp_path / "a.txt").write_text("x\n")
    query = text.print_stream(stream, str(tmp_path / "checkpoint"), "warning")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_latest_by_key(spark):
    df = orders(spark, (1, 10, 1), (1, 11, 2), (2, 20, 3))
    assert rows_of(latest_by_key(df, ["order_id"], ["seq"])) == [(1, 11, 2), (2, 20, 3)]


def test_merge_statement():
    sql = jdbc.merge_sql("orders", "side", ["order_id"], ["order_id", "price", "seq"])
    assert sql == (
        "MERGE INTO orders t USING side s ON t.order_id = s.order_id"
        " WHEN MATCHED THEN UPDATE SET price = s.price, seq = s.seq"
        " WHEN NOT MATCHED THEN INSERT (order_id, price, seq) VALUES (s.order_id, s.price, s.seq)"
    )
    key_only = jdbc.merge_sql("t1", "t2", ["window_end", "row_num"], ["window_end", "row_num"])
    assert "UPDATE" not in key_only and "t.window_end = s.window_end AND t.row_num = s.row_num" in key_only


def test_duplicate_key_statement():
    sql = jdbc.duplicate_key_sql("orders", "side", ["order_id"], ["order_id", "price", "seq"])
    assert sql == (
        "INSERT INTO orders (order_id, price, seq) SELECT order_id, price, seq FROM side"
        " ON DUPLICATE KEY UPDATE price = VALUES(price), seq = VALUES(seq)"
    )
    assert jdbc.duplicate_key_sql("t", "s", ["id"], ["id"]).endswith("UPDATE id = VALUES(id)")


def test_ranked_rows_fit_the_result_tables(spark):
    from pyspark.sql.types import StructType

    ranked = spark.createDataFrame([], "item_id long, window_end timestamp, cnt long, row_num long")
    assert jdbc.as_sink_columns(ranked).columns == StructType.fromDDL(jdbc.TOP_ITEMS_TYPES).names
    urls = ranked.withColumnRenamed("item_id", "url")
    assert jdbc.as_sink_columns(urls).columns == [c.split()[0] for c in jdbc.TOP_URLS_TYPES.split(", ")]


def test_jdbc_upsert_stages_then_merges(spark, monkeypatch):
    """No database is started here: the write and the statement are recorded."""
    from pyspark.sql import DataFrameWriter

    seen = []
    monkeypatch.setattr(
        DataFrameWriter, "jdbc",
        lambda self, url, table, mode=None, properties=None: seen.append((url, table, rows_of(self._df))),
    )
    monkeypatch.setattr(jdbc, "run_statement", lambda spark, url, props, sql: seen.append((url, sql)))
    write = jdbc.upsert_jdbc("jdbc:x", "orders", {}, ["order_id"], ["seq"])
    write(orders(spark, (1, 10, 1), (1, 11, 2)), 0)
    staging = seen[0][1]
    assert staging.startswith("orders_staging_") and seen[0] == ("jdbc:x", staging, [(1, 11, 2)])
    assert seen[1][1].startswith(f"MERGE INTO orders t USING {staging} s")
    jdbc.upsert_jdbc("jdbc:x", "orders", {}, ["order_id"], ["seq"])(orders(spark, (1, 1, 1)), 0)
    assert seen[2][1] != staging
    del seen[2:]

    jdbc.append_jdbc(orders(spark, (2, 3, 4)), "jdbc:x", "hot", {}, jdbc.COUNT_TYPES)
    assert seen[2] == ("jdbc:x", "hot", [(2, 3, 4)])


def test_temporary_tables_go(spark):
    from tidemark.session import scratch_path, temporary, written
    from tidemark.sinks.folders import is_complete

    kept = scratch_path(spark, "kept")
    with temporary(spark):
        inside = scratch_path(spark, "inside")
        spark.range(3).write.parquet(inside)
        written(spark.range(5), "also").write.parquet(kept)
    assert spark.read.parquet(kept).count() == 5
    assert not is_complete(spark, inside) and is_complete(spark, kept)
