"""Physical plans of the registered queries hold no operator that fails at scale."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
LIGHT = [n for n in sorted(QUERIES) if not n.startswith(("ml_", "fs_", "ano_", "den_", "st_", "sink_", "fill_knn"))]


@pytest.mark.parametrize("name", LIGHT)
def test_plan_has_no_cross_join_or_row_udf(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for mark in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert mark not in plan


@pytest.mark.parametrize("name", ["flt_time_range", "flt_time_split"])
def test_time_filters_reach_the_scan(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan or "LessThan(ts" in plan
