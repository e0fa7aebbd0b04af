"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import check, duck

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["nation", "segment", "orders", "total"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    n, problem = check(spark, con, FOLDER, entry.queries()[name], SQL.get(name))
    assert problem is None
    assert n > 0 or name in SQL
