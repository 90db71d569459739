"""Every registered query against its SQL oracle."""

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as entry
from emberlog.plans.catalog import QUERIES
from emberlog.plans.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["hour", "anomaly_count", "critical", "high", "medium", "low"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, oracle, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
