"""Plan regression tests: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry
from silverline.plans.queries import QUERIES
from tests.conftest import SF_SMOKE


def formatted(spark, df):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(plan):
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange \(\d+\)", plan))


@pytest.fixture(scope="module")
def static_plans(spark):
    """Plans with AQE off, so the static plan shows every exchange."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        yield lambda name: formatted(spark, entry.queries()[name](spark, SF_SMOKE))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_flagship_dedups_with_one_shuffle_and_a_partial_limit(static_plans):
    plan = static_plans("silver_videos")
    assert exchanges(plan) == 1
    limits = re.findall(r"row_number\(\), 1, (Partial|Final)", plan)
    assert sorted(limits) == ["Final", "Partial"]
    # the partial limit sits below the exchange (map side)
    tree = plan.split("\n\n")[0]
    assert tree.index("Exchange") < tree.rindex("WindowGroupLimit")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(static_plans, name):
    plan = static_plans(name)
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas)", plan)


def test_scans_read_only_used_columns(static_plans):
    plan = static_plans("negative_metric_rows")
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_acctbal:double>" in plan
    assert "LessThan(c_acctbal,0.0)" in plan
    plan = static_plans("manifest_counts")
    assert "ReadSchema: struct<lang:string,source:string>" in plan


def test_rollup_aggregates_before_joining(static_plans):
    plan = static_plans("category_rollup")
    tree = plan.split("\n\n")[0]
    # the customer aggregate is below both joins
    assert tree.rindex("HashAggregate") > tree.index("BroadcastHashJoin")
