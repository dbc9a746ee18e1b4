"""Plan shape: the physical plans are the ones intended for scale."""

from __future__ import annotations

import pytest

from tessera.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "PythonUDF")
QUADRATIC_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated PushedFilters
    return {k: plan_of(fn(spark, SF_SMALL)) for k, fn in QUERIES.items()}


def test_no_python_and_no_quadratic_operators_anywhere(plans):
    for key, plan in plans.items():
        for node in PYTHON_NODES + QUADRATIC_NODES:
            assert node not in plan, f"{key} has {node}"


def test_latest_per_key_limits_before_the_shuffle(plans):
    assert "WindowGroupLimit" in plans["win_latest"]


def test_org_tree_side_is_broadcast(plans):
    assert "BroadcastHashJoin" in plans["join_hierarchy"]


def test_event_filters_reach_the_scan(plans):
    p = plans["campaign_revenue"]
    assert "EqualTo(event_type,purchase)" in p
    assert "GreaterThanOrEqual(ts,2023-01-01T00:00)" in p


def test_window_filter_reaches_the_orders_scan(plans):
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plans["filter_range_closed"]


def test_budget_scan_reads_only_needed_columns(plans):
    text = plans["budget_forecast"]
    schemas = [s for s in text.split("ReadSchema: ")[1:] if "l_shipdate" in s]
    assert schemas
    for s in schemas:
        head = s.split("\n")[0]
        assert "l_tax" not in head and "l_linestatus" not in head and "l_suppkey" not in head


def test_count_distinct_is_partially_aggregated(plans):
    # partial_count(distinct ..) after a map-side aggregate on (keys, txn)
    assert plans["agg_count_distinct"].count("HashAggregate") >= 3


def test_ranked_keys_never_window_rows_over_the_bare_key(plans):
    # the split row number numbers rows per (partition id, key) slice; the only
    # window partitioned by the key alone runs over the slices table (at most
    # one row per partition), ordered by the partition id
    import re
    for key, part in (("join_composite", "SqlStudentDocumentId"), ("win_rn_case", "Student_GUID")):
        specs = re.findall(r"windowspecdefinition\(([^)]*)\)", plans[key])
        by_key = [w for w in specs if w.startswith(part)]
        assert by_key and all("__pid" in w.split("ASC")[0] for w in by_key), by_key


# ------------------------------------------------------------ joins as on a large cluster
@pytest.fixture(scope="module")
def wide(spark):
    """Plans of the pipelines when no side is small enough to be broadcast by size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = ("campaign_revenue", "lesson_summary", "activity_scores", "budget_forecast", "token_lookup",
                "persons_of_user", "retail_q2")
        return {k: plan_of(QUERIES[k](spark, SF_SMALL)) for k in keys}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def lines_above(plan: str, node: str) -> list[str]:
    """The operators of each ``node`` line's input, nearest first, down to the next scan."""
    out = []
    lines = plan.split("\n")
    for i, line in enumerate(lines):
        if node in line:
            out.append("\n".join(lines[i + 1:i + 6]))
    return out


def test_report_groups_are_dealt_anew_before_the_affiliate_join(wide):
    # the aggregate ends before the join: an exchange on the affiliate id lies between
    joins = [x for x in lines_above(wide["campaign_revenue"], "SortMergeJoin [affiliate_id")]
    assert joins and all("Exchange hashpartitioning(affiliate_id" in j for j in joins)


def test_other_districts_rows_stay_out_of_the_shuffles(wide):
    plan = wide["lesson_summary"]
    tests = [x for x in plan.split("\n") if "Filter" in x and "ubquery" in x and "xxhash64" in x]
    assert len(tests) >= 2  # the scores' and the history's scan


def test_lookups_fold_before_they_join(wide):
    # hot keys: a partial and a final aggregate below the join, none above the raw rows' semi join
    for key in ("token_lookup", "persons_of_user"):
        assert "HashAggregate" in wide[key] or "SortAggregate" in wide[key]
        assert wide[key].count("LeftSemi") <= 1


def test_the_calendar_is_broadcast_not_merged(wide):
    assert "SortMergeJoin [dayofweek" not in wide["budget_forecast"]
    assert "BroadcastHashJoin [dayofweek" in wide["budget_forecast"]


def test_not_in_has_no_nested_loop(wide):
    assert "LeftAnti" in wide["retail_q2"] and "NestedLoop" not in wide["retail_q2"]


def test_the_calendar_reads_its_source_once(plans):
    assert plans["union_distinct"].count("Scan parquet") <= 2  # lines and parts of the stand-in, once
