"""Properties of the physical plans that matter at scale."""

import re

import pytest

from millwright.plans.queries import registry
from millwright import contracts as c
from millwright.operators.project import in_quarter
from millwright.sources import tables
from tests.conftest import SMALL, utc

QUERIES = registry()
WRITERS = {"quarterly_tables", "tagged_files", "ingest_stream", "live_features", "overwritten_quarters", "sort_events",
           "profile_csv", "retained_readings", "erased_readings", "compacted_readings", "incremental_hrss_features",
           "incremental_logistics_features", "recognised_messages", "log_entries", "traced_events", "replayed_quarantine", "merged_quantiles",
           "csv_quarantine", "folded_features"}
# One row per class cell, per hour or per column meets in one task; nothing else may.
SMALL_SINGLES = {"class_weights", "hour_profile"}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_no_cross_join_no_nested_loop(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS - SMALL_SINGLES))
def test_no_window_over_a_whole_table(spark, name):
    """A single-partition exchange is allowed under a final aggregate only."""
    plan = plan_of(QUERIES[name](spark, SMALL))
    for window in re.findall(r"Window .*windowspecdefinition\((.*?)\)", plan):
        assert not window.startswith("1,")
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in below


def test_repeats_are_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["dedup_events"](spark, SMALL))
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]


def test_features_take_one_shuffle_and_read_only_their_columns(spark):
    plan = plan_of(QUERIES["hrss_features_quarterly"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_sum" in plan
    schema = re.search(r"ReadSchema: (\S+)", plan).group(1)
    assert "event_id" in schema and "user_id" in schema


def test_logistics_features_take_one_shuffle_and_no_join(spark):
    plan = plan_of(QUERIES["logistics_features_quarterly"](spark, SMALL))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_quarter_bounds_reach_the_file(spark):
    for name in ("quarter_filter", "window_filter"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThanOrEqual(l_shipdate" in plan


def test_quarter_prunes_raw_partitions(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    rows = events([{}, {"event_timestamp": utc("2025-05-01T00:00:00")}])
    tables.append_raw(rows, path, "event_timestamp", "0", ["asset_id"])
    quarter = in_quarter(tables.read_raw(spark, path, c.LOGISTICS_EVENTS), "event_timestamp",
                         "2025-01-01")
    plan = plan_of(quarter)
    partition_filters = re.search(r"PartitionFilters: \[(.*?)\], Pushed", plan).group(1)
    assert "event_month" in partition_filters and "2025-01-01" in partition_filters
    assert "GreaterThanOrEqual(event_timestamp" in plan
    assert quarter.count() == 1
    assert len(quarter.inputFiles()) <= 2


def test_exact_percentiles_read_their_table_once_for_both_steps(spark):
    frame = QUERIES["median_by_group"](spark, SMALL)
    frame.toArrow()
    final = plan_of(frame).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
