"""Every registered query with SQL must match DuckDB on the smallest tables."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, con, name):
    want = con.execute(SQL[name]).to_arrow_table()
    got = QUERIES[name](spark, sf).toArrow()
    assert compare(got, want) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert {r["segment"] for r in rows} >= {"Champions", "Others"}
