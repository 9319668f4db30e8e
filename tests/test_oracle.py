"""Every registered query runs; those with SQL give the same rows as DuckDB."""

from __future__ import annotations

import pytest
from compare import difference, open_tables

from keeprate import catalog

FOLDER = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, connection, name):
    df = catalog.queries()[name](spark, FOLDER)
    if name in SQL:
        assert difference(df, connection, SQL[name]) is None
    else:
        assert df.columns and df.collect() is not None


def test_every_sql_has_its_query():
    assert set(SQL) <= set(catalog.queries())
