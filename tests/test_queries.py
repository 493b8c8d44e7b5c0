"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import duck, mismatch

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert mismatch(df, con, sql) is None


def test_flagship_values(spark):
    row = entry.entry(spark).first()
    assert (row.n, row.mae, row.mape, row.rmse) == (3600, 0.120093, 0.021127, 0.296998)
