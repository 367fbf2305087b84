"""Every registered query against its DuckDB oracle (sf0.001; the driver uses sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()
SKIP = os.environ.get("QUARRY_SKIP_ORACLE") == "1"


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.skipif(SKIP, reason="QUARRY_SKIP_ORACLE=1")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


@pytest.mark.skipif(SKIP, reason="QUARRY_SKIP_ORACLE=1")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 1
