"""Every registered query against its SQL."""

import pytest
from conftest import SF_DIR
from oracle import connect, duck_rows, spark_rows

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    if name in ORACLES:
        assert (columns, rows) == duck_rows(con, ORACLES[name])
