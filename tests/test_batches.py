"""Registered streams run in several micro-batches, not one."""

from __future__ import annotations

import glob

import pytest

from tidemill.plans.registry import QUERIES
from tidemill.session import shared_dir

STREAMS = [
    "stateful_sum", "running_sum_stream", "state_map_income", "state_list_history", "changelog_sum_stream", "changelog_net_stream",
    "shared_state_rules", "timer_et_flush", "state_ttl_value_stream", "state_ttl_map_stream", "state_ttl_list_stream",
    "win_history_sum_stream", "win_accumulate_stream", "win_count_stream", "win_count_all_stream", "join_broadcast_cdc_stream",
    "word_count_stream", "win_tumble_stream", "win_slide_stream", "win_session_stream", "late_side_output_stream",
    "join_window_inner_stream", "join_window_left_stream", "join_interval_stream", "join_lookup_stream",
]


def commits(spark):
    base = shared_dir(spark).removeprefix("file://")
    return {f.rsplit("/", 1)[0]: 1 for f in glob.glob(f"{base}/tidemill/*/checkpoint/commits/2")}


@pytest.mark.parametrize("name", STREAMS)
def test_several_micro_batches(spark, folder, name):
    before = commits(spark)
    QUERIES[name](spark, folder)
    assert len(commits(spark)) > len(before)
