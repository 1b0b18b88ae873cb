"""Plan-shape guards: properties of the final (post-AQE) physical plans that
the scale design depends on."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF001


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    qe.toRdd().count()  # run this very plan so AQE's final plan is shown
    return qe.executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture(scope="module")
def plans(spark):
    return {name: final_plan(fn(spark, SF001)) for name, fn in E.queries().items()
            if not re.match(r"op\d+_|pipeline", name)}  # those have tests of their own


def test_no_cross_joins_anywhere(plans):
    for name, p in plans.items():
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


def test_all_resolutions_from_one_scan_with_group_limit(plans):
    p = plans["enb_cover_all"]
    assert p.count("FileScan") == 1
    assert "WindowGroupLimit" in p  # map-side top-n before the shuffle


def test_grid_kpi_reads_only_used_columns(plans):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plans["grid_kpi"])
    # the measures' branch, and the narrow one that counts subscribers
    assert len(schemas) == 2 and not any("props" in s for s in schemas)
    assert sorted("value" in s for s in schemas) == [False, True]


def _unpartitioned(plan: str) -> list[str]:
    # The first argument of an unpartitioned window spec is an ordering.
    specs = re.findall(r"windowspecdefinition\(([^,]*)", plan)
    return [s for s in specs if " ASC" in s or " DESC" in s or s.startswith("specifiedwindowframe")]


def test_windows_are_partitioned(plans, spark):
    """Every window is partitioned by a key, except the one that numbers the
    partitions of a sort for the bursts (checked to be caught)."""
    w = Window.orderBy("id")
    alone = spark.range(9).select(F.row_number().over(w).alias("n"))
    assert _unpartitioned(final_plan(alone))
    for name, p in plans.items():
        if name not in ("access_burst", "burst_witnesses", "burst_big_keys"):
            assert not _unpartitioned(p), name


def test_no_round_robin_and_no_python_in_the_library_queries(plans):
    for name, p in plans.items():
        if "round_trip" in name:  # their sinks are asked for a number of files
            continue
        assert "RoundRobinPartitioning" not in p, name
        assert "Python" not in p and "Pandas" not in p and "Arrow" not in p, name


def test_topn_plan_has_one_window_one_join_and_no_raw_pair_join(plans):
    p = plans["enb_cover_1000"]
    assert len(re.findall(r"\bWindow \[", p)) == 1
    assert len(re.findall(r"(SortMerge|BroadcastHash|ShuffledHash)Join", p)) == 1


def test_window_bounds_reach_the_scan(plans):
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plans["weekly_window_counts"])
    assert any("GreaterThanOrEqual(ts" in x and "LessThan(ts" in x for x in pushed)
