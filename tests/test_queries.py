"""Every registered query against DuckDB on the smallest data set, and the driver contract."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workloads.catalog import QUERIES
from workloads.check import compare, duckdb_session

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def con(sf):
    return duckdb_session(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, con, sf, name):
    same, rows, why = compare(spark, con, queries()[name], oracle_sql().get(name), sf)
    assert same, why
    assert rows > 0


def test_entry(spark):
    routes = entry(spark)
    assert routes.columns == ["route", "n_messages"]
    counts = [r.n_messages for r in routes.collect()]
    assert (len(counts), sum(counts)) == (12, 840)


def test_every_oracle_has_a_query():
    assert {n for n in oracle_sql() if n in NAMES} == set(NAMES)
