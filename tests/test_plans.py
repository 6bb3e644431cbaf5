"""Plan guards over every registered query (planned at sf0.001, not executed).

No registered query may plan a nested-loop or cartesian join or evaluate Python.
"""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NESTED_LOOP = re.compile(r"BroadcastNestedLoopJoin|CartesianProduct")
PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF")


# jobs that write and return a plain read of what they wrote: their plan says nothing, and planning them runs them
WRITTEN = re.compile(r"(streamed_|ingested_|merged_|model_run|model_increments|evolved_table|json_round_trip|csv_round_trip)")


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if not re.match(r"op\d+_|pipeline$", n) and not WRITTEN.match(n)))
def test_no_nested_loop_or_stray_python(spark, name):
    plan = _plan(spark, name)
    assert not NESTED_LOOP.search(plan), f"{name} plans a nested-loop / cartesian join"
    assert not PYTHON.search(plan), f"{name} evaluates Python in its plan"


def test_lookback_reaches_the_scan(spark):
    plan = _plan(spark, "read_top_tracks")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


@pytest.mark.parametrize("name", ["real_duration_lead", "real_duration_daily", "sampled_polyline"])
def test_per_entity_order_has_no_entity_window(spark, name):
    """The per-listener lead and the per-user point numbering are windows over
    one bucket's rows: every window over rows is partitioned by the fine bucket."""
    plan = _plan(spark, name)
    windows = re.findall(r"Window \[(?:row_number\(\)|lead\(played_at)[^\]]*\], \[([^\]]*)\]", plan)
    assert windows and all("_b2#" in w for w in windows)
    assert "monotonically_increasing_id" not in plan and "SPARK_PARTITION_ID" not in plan
