"""Every registered query against its SQL on the given tables."""

import oracle
import pytest

from tidemark.catalogue import QUERIES, SQL


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf, con, name):
    columns, rows = oracle.spark_rows(QUERIES[name](spark, sf))
    want_columns, want = oracle.sql_rows(con, SQL[name])
    assert columns == want_columns
    assert rows == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(QUERIES)
