"""Every registered query against its SQL on the same tables."""

import pytest
from compare import connect, difference

from __spark_entry__ import QUERIES, entry, oracle_sql

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, FOLDER), tables, oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_returns_rows(spark):
    assert entry(spark).count() > 0
