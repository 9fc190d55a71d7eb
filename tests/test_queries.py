"""Every registered query against its oracle, and what its plan must not contain."""

import os

import pytest

import __spark_entry__ as driver
from workload.check import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_registry():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert [f.name for f in driver.entry(spark).schema] == ["method", "n", "accuracy"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_oracle(spark, con, name):
    assert compare(spark, con, name, SF_DIR) == ""


def plan(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_scalable(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in text
    # Replaying a chain walks through its steps in Arrow batches; everything else stays on the JVM side.
    if name != "mh_replay":
        for operator in ("EvalPython", "InPandas", "InArrow"):
            assert operator not in text


@pytest.mark.parametrize("name", ["grade_runs", "grade_simple", "extract_robust", "per_example",
                                  "run_params", "token_logprob", "mh_log_accept", "block_schedule"])
def test_row_local_queries_do_not_shuffle(spark, name):
    """Nothing but the spreading of an input that cannot be split."""
    text = plan(spark, name)
    exchanges = text.count("Exchange")
    assert exchanges == text.count("REPARTITION_BY_NUM") <= 1
