"""Every registered query against its SQL, on the smallest tables."""

import pytest

import oracle
from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def test_registry():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "role" in df.columns


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, sf, name):
    columns, got = oracle.spark_rows(queries()[name](spark, sf))
    sql = oracle_sql().get(name)
    if sql is None:
        assert got
        return
    wanted_columns, wanted = oracle.duck_rows(con, sql)
    assert columns == wanted_columns
    assert got == wanted
