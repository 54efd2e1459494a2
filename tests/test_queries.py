"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as registry
from tests.oracle import connect, differences

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    if name in SQL:
        assert differences(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert registry.entry(spark).count() > 0
