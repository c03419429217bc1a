"""Every registered query against the same question asked of DuckDB, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from bodega.queries import REGISTRY
from tests.compare import differences, oracle_connection
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SMALL)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_oracle(spark, tables, oracle, name):
    query = REGISTRY[name]
    if query.oracle is None:
        assert query.run(tables).count() > 0
    else:
        problem = differences(query.run(tables), oracle, query.oracle)
        assert problem is None, problem


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
