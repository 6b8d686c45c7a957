"""Every registered query with a SQL counterpart equals it; the contract of the entry module holds."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import check, connect

SQL = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, con, sf, name):
    status, _, _, note = check(spark, con, name, sf, queries()[name], oracle_sql()[name])
    assert status == "ok", note
