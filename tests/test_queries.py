"""Every registered query that has an SQL twin equals it at the smallest scale."""

import pytest

import __spark_entry__ as entry
from check import duck, same_result

FOLDER = "/root/testdata/sf0.001"
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.TEXT_QUERIES}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    assert same_result(frame, con, ORACLES[name]) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 20
