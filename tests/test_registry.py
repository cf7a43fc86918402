import pytest

import __spark_entry__ as registry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = registry.own_queries(), registry.own_oracle_sql()


MADE = {}


def made(spark, name):
    """Each query once; both tests look at the same one."""
    if name not in MADE:
        MADE[name] = QUERIES[name](spark, FOLDER)
    return MADE[name]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, FOLDER, lambda spark, folder: made(spark, name), ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_cross_product_and_no_row_at_a_time_python(spark, name):
    plan = made(spark, name)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
