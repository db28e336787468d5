"""Every catalogue query against its SQL check, and the shape of all plans."""

import pytest
from comparing import differences, duck

import __spark_entry__ as entry
from zoneflow.plans.catalogue import QUERIES
from zoneflow.plans.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
UNCHECKED = {"kmeans_profiles", "forest_predictions", "mlp_predictions", "model_comparison"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_check_but_the_iterative_ones():
    assert set(QUERIES) - set(ORACLE) == UNCHECKED
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - UNCHECKED))
def test_query_matches_sql(spark, con, name):
    result = QUERIES[name](spark, FOLDER)
    text = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text
    assert differences(result, con, ORACLE[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
