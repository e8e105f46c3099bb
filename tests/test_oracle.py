"""Every registered query with an oracle text agrees with DuckDB on sf0.001."""

import pytest

import __spark_entry__ as E

from .conftest import SMALL
from .oracle import compare, duck_connection

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SMALL)
    assert r["schema"], r.get("detail")
    assert r["rows"] == r["oracle_rows"]
    assert r["values"], r.get("detail")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 10
