"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module

FOLDER = entry_module.SMOKE_DIR
NAMES = sorted(entry_module.queries())


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    sql = entry_module.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert compare(df, duck, sql) is None


def test_every_sql_has_its_query():
    assert set(entry_module.oracle_sql()) <= set(NAMES)


def test_flagship(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "net_revenue" in df.columns
