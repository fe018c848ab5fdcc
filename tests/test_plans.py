"""What the plans of the registered queries must and must not hold."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from strata import registry
from strata.operators.clean import range_filter

SF_DIR = "/root/testdata/sf0.001"

#: What plans call the steps that run Python code.
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "InPandas", "MapInArrow", "InArrow")


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_no_cross_join_and_no_window_over_everything(spark, name):
    df = registered.queries()[name](spark, SF_DIR)
    plan = physical(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in registry.QUERIES:
        assert not [word for word in PYTHON if word in plan]
    for node in nodes(df._jdf.queryExecution().optimizedPlan()):
        if node.nodeName() == "Window":
            assert not node.partitionSpec().isEmpty(), node.simpleString(200)


def read_columns(plan: str) -> set[str]:
    found = set()
    for part in plan.split("ReadSchema: struct<")[1:]:
        found |= {field.split(":")[0] for field in part.split(">")[0].split(",")}
    return found


def test_only_used_columns_are_read(spark):
    plan = physical(registered.queries()["daily_summary"](spark, SF_DIR))
    assert read_columns(plan) == {"l_quantity", "l_extendedprice", "l_tax", "l_shipdate", "o_totalprice", "o_orderdate"}
    assert read_columns(physical(registered.queries()["check_uniqueness"](spark, SF_DIR))) <= {"l_orderkey", "l_linenumber", ""}


def test_aggregates_are_partial_before_the_shuffle(spark):
    plan = physical(registered.queries()["daily_rollup"](spark, SF_DIR))
    assert "partial_avg" in plan[plan.index("Exchange"):]


def test_windows_of_one_series_share_one_sort(spark):
    plan = physical(registered.queries()["rolling_6"](spark, SF_DIR))
    assert plan.count("Window [") == 1


def test_cut_series_share_one_shuffle(spark):
    df = registered.queries()["rolling_events"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in physical(df)


def test_bounds_reach_the_scan(spark):
    rows = range_filter(spark.read.parquet(f"{SF_DIR}/events.parquet"), {"value": (1, 50)})
    assert "GreaterThanOrEqual(value,1.0)" in physical(rows) and "LessThanOrEqual(value,50.0)" in physical(rows)
