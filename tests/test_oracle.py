"""Every registered query against its DuckDB oracle SQL (row multiset,
column names), on the smallest driver tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

from .conftest import SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["status"] == "OK", r["status"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == [
        "cust_nation", "supp_nation", "l_returnflag", "total_revenue", "line_count", "gid"]
