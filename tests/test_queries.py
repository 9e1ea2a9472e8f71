"""Every registered query runs; those with SQL give the rows of their SQL."""

import pytest

import __spark_entry__ as E
from tests.compare import compare, connect

QUERIES, SQL = E.queries(), E.oracle_sql()
OWN = [n for n in QUERIES if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", OWN)
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in SQL:
        assert compare(df, con, SQL[name]) == ""
    else:
        assert df.count() > 0  # tests/test_recurrences.py has their rows


def test_entry(spark):
    assert E.entry(spark).count() > 0
