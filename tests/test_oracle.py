"""Every registered query against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], SQL.get(name)) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
