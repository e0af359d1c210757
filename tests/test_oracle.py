"""Every registered query against its SQL over the same tables."""

import pytest
from checking import compare, database
from conftest import SF_DIR

from __spark_entry__ import entry, oracle_sql, queries
from lakeworks import queries as registered

QUERIES, ORACLES = registered.load()


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, db, sf_dir, name):
    assert compare(QUERIES[name](spark, sf_dir), db, ORACLES[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows == sorted(rows, key=lambda r: -r["revenue"])
