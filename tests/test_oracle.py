import pytest
from compare import check, connect
from conftest import DATA

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, DATA)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns and df.count() >= 0
    else:
        check(df, con, sql)


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["item_id", "window_end", "cnt", "row_num"]
    assert df.count() > 0
