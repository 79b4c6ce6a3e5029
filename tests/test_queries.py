"""Every registered query against its SQL on the smallest tables, and what its plan may not contain."""

import pytest

import __spark_entry__ as contract
import checks
from tests.compare import connection, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connection(FOLDER)


def test_every_query_has_sql():
    """The corpus operators have tests of their own."""
    assert checks.QUERIES.keys() == checks.ORACLES.keys()
    assert checks.QUERIES.items() <= contract.queries().items() and checks.ORACLES.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, oracle, name):
    df = checks.QUERIES[name](spark, FOLDER)
    assert difference(df, oracle, checks.ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert forbidden not in plan


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and all(-2.0 <= r.total_simi <= 2.0 + 1e-9 for r in rows)
