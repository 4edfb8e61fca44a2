"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pytest

BATCH = [
    "running_sum", "running_max", "running_max_by_first", "ad_count", "ad_count_running", "income_running",
    "user_history", "changelog_sum", "win_tumble", "win_slide", "win_session", "win_top3", "win_history_sum",
    "win_count", "win_count_all", "late_side_output", "join_window_inner", "join_window_left", "join_category_amount",
    "join_interval", "join_ip_range", "sql_ip_location", "join_lookup", "join_broadcast_cdc",
    "co_group", "word_count", "prj_json_clean", "src_csv_table", "state_ttl_list", "sql_udtf_split",
]


def plan(spark, folder, name):
    from __spark_entry__ import queries

    df = queries()[name](spark, folder)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_native_and_without_products(spark, folder, name):
    text = plan(spark, folder, name)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


def test_global_order_never_puts_rows_into_one_task(spark, folder):
    """The only single-partition step of a global scan is over block summaries, behind an aggregate."""
    for name in ("win_count_all", "late_side_output"):
        lines = plan(spark, folder, name).splitlines()
        single = [n for n, line in enumerate(lines) if "Exchange SinglePartition" in line]
        assert single
        for n in single:
            assert "HashAggregate" in lines[n + 1]


def test_running_sum_shuffles_rows_once(spark, folder):
    """Above the union of rows and openers there is one shuffle; below it only aggregates are shuffled."""
    text = plan(spark, folder, "running_sum")
    top, below = text.split("Union", 1)
    assert top.count("Exchange hashpartitioning") == 1
    lines = below.splitlines()
    shuffles = [n for n, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert shuffles and all("HashAggregate" in lines[n + 1] for n in shuffles)


def test_filter_and_columns_reach_the_scan(spark, folder):
    text = plan(spark, folder, "flt_since")
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in text.replace(":00:00", ":00")
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in text
    assert "ReadSchema: struct<text:string>" in plan(spark, folder, "word_count")


def test_top_rows_are_limited_before_the_shuffle(spark, folder):
    text = plan(spark, folder, "win_top3")
    assert text.count("WindowGroupLimit") == 2


def test_levels_share_one_row_shuffle(spark, folder):
    text = plan(spark, folder, "income_running")
    top = text.split("Union")[0]
    assert top.count("Exchange") == 1


def test_running_distinct_counts_join_no_rows(spark, folder):
    """First rows are marks in the scan; the only join is with the bounded list of hot keys."""
    text = plan(spark, folder, "ad_count_running")
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
