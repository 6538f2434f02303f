import pytest
from compare import check, connect
from conftest import DATA

import __spark_entry__ as contract

NAMES = [n for n in contract.queries() if n.startswith("op")]


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(set(NAMES) & set(contract.oracle_sql())))
def test_query_equals_sql(spark, con, name):
    check(contract.queries()[name](spark, DATA), con, contract.oracle_sql()[name])


def test_all_are_registered():
    assert {n.split("_")[0] for n in NAMES} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in contract.queries()


def test_empty_tables(spark, tmp_path):
    """Every query gives no rows, of the same columns, for tables without rows."""
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        spark.read.parquet(f"{DATA}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    for name in NAMES:
        rows = contract.queries()[name](spark, str(tmp_path)).collect()
        assert len(rows) == (1 if name.startswith("op4") else 0), name  # op4 adds a conversation
