"""Plan-shape checks: the properties that matter at scale, asserted on the physical plan."""

import re

import pytest

from tidemark.plans.driver_queries import QUERIES

from .conftest import SMOKE_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fct_funnel_is_one_scan_with_expand(spark):
    p = plan(QUERIES["fct_funnel"](spark, SMOKE_DIR))
    assert p.count("FileScan parquet") == 1
    assert "Expand" in p


@pytest.mark.parametrize(
    "name",
    ["int_user_activity", "int_funnel_steps", "fct_ab_tests", "fct_cohort_weekly", "fct_feature_engagement",
     "retention_weekly", "retention_monthly", "behavior_table", "dq_relationships", "funnel"],
)
def test_no_python_on_event_rows(spark, name):
    p = plan(QUERIES[name](spark, SMOKE_DIR))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_node_in_any_registered_query(spark, name):
    # both statistics tails are JVM expressions
    p = plan(QUERIES[name](spark, SMOKE_DIR))
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("name", ["int_user_activity", "retention_weekly", "fct_ab_tests", "behavior_table", "fct_cohort_weekly"])
def test_no_window_over_event_rows(spark, name):
    assert "Window" not in plan(QUERIES[name](spark, SMOKE_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(QUERIES["funnel"](spark, SMOKE_DIR))
    assert re.search(r"PushedFilters: \[[^\]]*In\(o_orderpriority", p)
    for scan in re.findall(r"ReadSchema: struct<([^>]*)>", p):
        assert "o_totalprice" not in scan and "o_comment" not in scan


def test_relationship_check_preaggregates_child_keys(spark):
    p = plan(QUERIES["dq_relationships"](spark, SMOKE_DIR))
    # the child side is aggregated by key before any join
    assert "partial_count" in p
