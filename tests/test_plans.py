"""Physical-plan properties the design depends on (read from explain output)."""

from __future__ import annotations

import contextlib
import io

import pytest

from webevents.plans.catalog import QUERIES
from conftest import SF01


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_scan_prunes_shards_and_stays_in_the_jvm(spark, name):
    df = QUERIES[name](spark, SF01)
    plan = plan_of(df)
    assert "PartitionFilters: [isnotnull(table_suffix" in plan, name
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert python_node not in plan, name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


@pytest.mark.parametrize(
    "name",
    ["funnel_overall", "funnel_by_channel", "funnel_by_device", "new_vs_returning", "weekly_growth"],
)
def test_flag_funnels_do_not_expand_rows(spark, name):
    # one COUNT(DISTINCT CASE ...) per step would plan an Expand (a copy of every row
    # per step); the per-user flag form never does
    assert "Expand" not in optimized(QUERIES[name](spark, SF01))


@pytest.mark.parametrize(
    "name", ["retention_cohorts", "purchase_cohorts", "ltv_by_channel", "funnel_stage_dropoff"]
)
def test_single_scan_forms_have_no_join(spark, name):
    plan = optimized(QUERIES[name](spark, SF01))
    assert "Join" not in plan, name
    assert plan.count("Relation [") == 1, name


def test_nested_fields_are_pruned(spark):
    plan = formatted(QUERIES["channel_performance"](spark, SF01))
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "geo" not in read_schema and "device" not in read_schema
    assert "string_value" not in read_schema  # only the int slot of event_params is read
    assert "event_params:array<struct<key:string,value:struct<int_value:bigint>>>" in read_schema


def test_partial_aggregation_before_every_shuffle(spark):
    plan = plan_of(QUERIES["ltv_by_channel"](spark, SF01))
    # a map-side partial aggregate runs below the first exchange
    assert "partial_min" in plan or "partial_count" in plan


def test_top_k_is_take_ordered(spark):
    plan = plan_of(QUERIES["session_conversion"](spark, SF01))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_all_aggregates_are_hash_based(spark, name):
    # a variable-width aggregation buffer (e.g. min over a struct of strings) makes
    # Spark fall back to sorting every input row
    plan = plan_of(QUERIES[name](spark, SF01))
    if name.endswith("_bitmaps"):
        return  # a bitmap is no fixed-width number; what is sorted are blocks of bitmaps, not events
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan, name


def _tree(plan_text: str):
    """(depth, operator) pairs of a physical plan's tree text."""
    nodes = []
    for line in plan_text.splitlines():
        stripped = line.lstrip(" :+-")
        if not stripped or stripped.startswith("("):
            continue
        depth = len(line) - len(stripped)
        nodes.append((depth, stripped.split("(")[0].split(" [")[0].strip()))
    return nodes


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_event_rows_are_aggregated_before_any_shuffle(spark, name):
    # below every Exchange, the path down to the scan must pass a HashAggregate
    # (a map-side partial aggregate), so raw event rows are never shuffled
    if name in ANY or name.endswith("_bitmaps"):
        return  # bitmaps hold no events; of the others, what it shuffles first is the limited rows, ten or twenty of them
    nodes = _tree(plan_of(QUERIES[name](spark, SF01)))
    for i, (depth, op) in enumerate(nodes):
        if not op.startswith("Exchange"):
            continue
        seen_aggregate = False
        for d, below in nodes[i + 1:]:
            if d <= depth:
                break
            if below.startswith(("Exchange", "ShuffleQueryStage")):
                break
            if below.startswith("HashAggregate"):
                seen_aggregate = True
            if below.startswith(("FileScan", "Scan parquet", "BatchScan")):
                assert seen_aggregate, f"{name}: an Exchange reads event rows without a partial aggregate"
                break


# previews (A1, A2) and top-k reports (A5, A7) are the only analyses whose result is cut
ANY = {"event_preview_any", "page_view_params_any"}
LIMITED = ANY | {"event_preview", "page_view_params", "session_conversion", "top_sources", "top_sources_best5", "top_sources_min860"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_only_previews_and_top_k_reports_limit_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SF01))
    limited = any(op in plan for op in ("TakeOrderedAndProject", "GlobalLimit", "CollectLimit", "LocalLimit"))
    assert limited == (name in LIMITED), name
    # and nothing samples or filters the input down to a subset
    assert "Sample" not in plan, name
