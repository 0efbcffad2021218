"""Every registered query against its SQL on the smallest tables."""

import pytest

from compare import connect, difference, spark_rows, sql_rows
from __spark_entry__ import entry, oracle_sql, queries
from registry.oracle import ORACLE
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_names():
    assert set(ORACLE) == set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    assert difference(spark_rows(queries()[name](spark, SF_DIR)), sql_rows(database, oracle_sql()[name])) is None
