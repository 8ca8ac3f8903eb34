"""Every registered query against its SQL twin, and checks of the plans' shape."""

import os

import pytest

import __spark_entry__ as entry
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, name):
    _, _, verdict = compare(spark, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_every_query_has_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["gold_event_matrix", "gold_schools", "gold_yearly", "points_in_polygons_grid", "deviation_global"])
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["gold_event_matrix", "gold_yearly", "yoy_by_rows", "numeric_named_aggs", "raw_scan"])
def test_no_unpartitioned_window(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    assert "Exchange SinglePartition" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["code_filter"](spark, FOLDER))
    assert "PushedFilters: [In(c_mktsegment" in plan and "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan
