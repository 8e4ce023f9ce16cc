"""Every SQL-expressible registered query equals its DuckDB statement on
the smallest driver tables (the driver repeats this at sf0.01)."""

import os

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from wardline.checks.compare import check, duckdb_connection

SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.skipif(not os.path.exists(SF_SMALL), reason="driver tables absent")
@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    res = check(spark, name, SF_SMALL, E.queries(), SQLS, con)
    assert res["ok"], res


def test_every_oracle_has_a_query():
    assert set(SQLS) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert "label_can_discharge_24h" in df.columns
    assert df.count() >= 0
