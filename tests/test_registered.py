"""Every registered query against its SQL, and the contract of the entry module."""

import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from tests.oracle import connect, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(TESTDATA)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"status", "doc_count", "avg_price"}


def test_every_sql_has_a_query():
    assert SQL.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, TESTDATA, QUERIES[name], SQL[name]) == []
