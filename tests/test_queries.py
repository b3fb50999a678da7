"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from workload.catalog import REGISTRY
from workload.run_check import compare, connect

ORACLES = entry.oracle_sql()
QUERIES = {name: entry.queries()[name] for name in REGISTRY}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert name in ORACLES, "every query has a check statement"
    assert compare(df, duck, ORACLES[name]) is None


def test_entry_returns_rows_with_a_stable_schema(spark):
    first, second = entry.entry(spark), entry.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0
