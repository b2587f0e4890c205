"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from checks import oracles
from checks import queries as checked
from checks.compare import differences, duckdb_session

ORACLES = oracles.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in checked.queries()}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duckdb_session(sf_dir)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, connection, name):
    frame = QUERIES[name](spark, sf_dir)
    assert differences(connection, frame, ORACLES[name]) == []


def test_entry_returns_rows(spark):
    frame = entry.entry(spark)
    assert frame.columns[:2] == ["u", "agg_time"]
    assert frame.count() > 0
