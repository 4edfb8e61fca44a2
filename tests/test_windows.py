"""Windows and late rows at their boundaries."""

from __future__ import annotations

import random
from datetime import timezone

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemill.operators import late as l
from tidemill.operators import windows as w

DDL = "ms bigint, word string, cnt bigint, seq bigint"


def timed(spark, *data):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], DDL)
    return df.withColumn("ts", F.timestamp_millis("ms"))


def ms(value):
    return round(value.replace(tzinfo=timezone.utc).timestamp() * 1000)


def spans(df, *names):
    return sorted((ms(x.win_start), ms(x.win_end), *[x[n] for n in names]) for x in df.collect())


def total():
    return {"total": F.sum("cnt")}


def test_tumbling_is_closed_at_the_start_and_open_at_the_end(spark):
    df = timed(spark, (1634720400000, "spark", 3), (1634720409998, "hive", 2), (1634720409999, "spark", 1), (1634720410000, "spark", 9))
    out = w.tumbling(df, ["word"], "ts", "10 seconds", {**total(), "first": F.min_by("ms", "seq")})
    assert spans(out, "word", "total", "first") == [
        (1634720400000, 1634720410000, "hive", 2, 1634720409998),
        (1634720400000, 1634720410000, "spark", 4, 1634720400000),
        (1634720410000, 1634720420000, "spark", 9, 1634720410000),
    ]


def test_sliding_panes_equal_native_sliding(spark):
    rnd = random.Random(1)
    df = timed(spark, *[(rnd.randrange(60_000), rnd.choice("ab"), rnd.randrange(9)) for _ in range(200)])
    native = w.sliding(df, ["word"], "ts", "10 seconds", "5 seconds", total())
    panes = w.sliding_from_panes(df, ["word"], "ts", "10 seconds", "5 seconds", total())
    assert rows(native) == rows(panes)


def test_hop_sample(spark):
    data = [(1000, "u1", 5), (2000, "u1", 5), (2000, "u2", 3), (3000, "u1", 5), (4000, "u1", 5), (9999, "u2", 3)]
    out = w.sliding(timed(spark, *data), ["word"], "ts", "10 seconds", "2 seconds", total())
    got = {(x.word, ms(x.win_start)): x.total for x in out.collect()}
    assert got[("u1", 0)] == 20 and got[("u2", 0)] == 6
    assert got[("u1", -8000)] == 5 and got[("u1", 4000)] == 5 and got[("u2", 8000)] == 3
    assert len([k for k in got if k[0] == "u1"]) == 7


def test_session_gap_equal_to_the_timeout_still_joins(spark):
    df = timed(spark, (0, "a", 1), (5000, "a", 2), (10001, "a", 4), (3000, "b", 8))
    assert spans(w.sessions(df, ["word"], "ts", 5, total()), "word", "total") == [
        (0, 10000, "a", 3), (3000, 8000, "b", 8), (10001, 15001, "a", 4),
    ]


def test_sessions_equal_brute_force_with_hot_key(spark):
    rnd = random.Random(9)
    data = [(rnd.randrange(0, 400_000), "hot" if rnd.random() < 0.5 else rnd.choice("abc"), 1) for _ in range(250)]
    want = []
    for key in {d[1] for d in data}:
        times = sorted(d[0] for d in data if d[1] == key)
        start = last = times[0]
        n = 0
        for t in times:
            if t - last > 5000:
                want.append((start, last + 5000, key, n))
                start, n = t, 0
            last, n = t, n + 1
        want.append((start, last + 5000, key, n))
    assert spans(w.sessions(timed(spark, *data), ["word"], "ts", 5, total()), "word", "total") == sorted(want)


def test_count_windows_drop_the_unfinished_rest(spark):
    data = [(0, "a", i) for i in range(1, 13)] + [(0, "b", 1)] * 4
    df = timed(spark, *data)
    for width in (3, 1000):
        assert rows(w.count_windows(df, ["word"], "seq", 5, total(), width)) == [("a", 0, 15), ("a", 1, 40)]
        assert rows(w.count_windows(df, [], "seq", 5, total(), width)) == [(0, 15), (1, 40), (2, 26)]


def test_top_rows_keep_arrival_order_of_equals(spark):
    df = timed(spark, (0, "spark", 5), (1, "spark", 8), (2, "spark", 3), (3, "spark", 6), (4, "spark", 5))
    out = w.top_rows(df, ["word"], "ts", "10 seconds", "cnt", "seq", 3)
    assert [(x.cnt, x.seq) for x in out.orderBy("rank").collect()] == [(8, 1), (6, 3), (5, 0)]


def test_history_sums_go_on_over_windows(spark):
    df = timed(spark, (0, "a", 1), (1000, "a", 2), (6000, "a", 4), (20000, "a", 8))
    out = w.history_sums(df, ["word"], "ts", "5 seconds", F.sum("cnt"))
    assert [(x.win_sum, x.history_sum) for x in out.orderBy("win_start").collect()] == [(3, 3), (4, 7), (8, 15)]


def test_accumulator(spark):
    acc = w.Accumulator({"s": F.sum("cnt"), "n": F.count("cnt")}, lambda p: {"mean": p["s"] / p["n"]})
    out = w.accumulate(timed(spark, (0, "a", 1), (1, "a", 2)), ["word"], "ts", "5 seconds", acc)
    assert [x.mean for x in out.collect()] == [1.5]


def test_late_row_by_row(spark):
    """9999 ends the first window, so 5000 comes too late, although 10000 is still on time."""
    df = timed(spark, (1000, "a", 1), (9999, "a", 2), (10000, "a", 4), (5000, "a", 8))
    for width in (1, 100):
        on_time, late = l.split_late(df, "ts", "seq", 10, width=width)
        assert rows(late.select("ms")) == [(5000,)]
        out = w.tumbling(on_time, ["word"], "ts", "10 seconds", total())
        assert spans(out, "total") == [(0, 10000, 3), (10000, 20000, 4)]
    assert l.split_late(df, "ts", "seq", 10, delay_seconds=2)[1].count() == 0
    assert l.split_late(df.limit(1), "ts", "seq", 10, seen_before=9_999_000)[1].count() == 1


def test_late_sql_sample(spark):
    df = timed(spark, (11000, "u1", 5), (12000, "u1", 5), (2000, "u2", 3), (3000, "u1", 5), (19999, "u2", 3))
    assert rows(l.split_late(df, "ts", "seq", 10)[1].select("ms")) == [(2000,), (3000,)]


def test_late_equals_brute_force(spark):
    rnd = random.Random(4)
    data = [(max(0, i * 700 - rnd.choice([0, 0, 3000, 20_000])), "a", 1) for i in range(150)]
    seen, want = None, []
    for t, *_ in data:
        end = t - t % 10_000 + 9_999
        want.append(seen is not None and end <= seen)
        seen = t if seen is None else max(seen, t)
    out = l.mark_late(timed(spark, *data), "ts", "seq", 10, width=8)
    assert [x.is_late for x in out.orderBy("seq").collect()] == want


@pytest.mark.parametrize("call", ["tumbling", "sessions", "top", "late"])
def test_empty_input(spark, call):
    df = timed(spark, (0, "a", 1)).limit(0)
    out = {
        "tumbling": lambda: w.tumbling(df, ["word"], "ts", "5 seconds", total()),
        "sessions": lambda: w.sessions(df, ["word"], "ts", 5, total()),
        "top": lambda: w.top_rows(df, ["word"], "ts", "5 seconds", "cnt", "seq"),
        "late": lambda: l.mark_late(df, "ts", "seq", 5),
    }[call]()
    assert out.collect() == []


def test_null_key_is_a_key(spark):
    df = timed(spark, (0, None, 1), (1, None, 2))
    assert spans(w.sessions(df, ["word"], "ts", 5, total()), "total") == [(0, 5001, 3)]


@pytest.mark.parametrize("keys", [["word"], []])
def test_sessions_over_blocks_equal_plain_ones(spark, keys):
    """A third of the slots on one key, cut into blocks far shorter than its sessions."""
    rnd, at, data = random.Random(9), 0, []
    for _ in range(1500):
        at += rnd.choice([1, 900, 2500, 4999, 5000, 5001, 40_000])
        data.append((at, rnd.choice("hhab"), rnd.randrange(9)))
    df = timed(spark, *data)
    plain = w.sessions(df, keys, "ts", 5, total(), blocked=False)
    cut = w.sessions(df, keys, "ts", 5, total(), blocked=True, block_slots=8)
    assert rows(cut.select(*keys, "win_start", "win_end", "total")) == rows(plain.select(*keys, "win_start", "win_end", "total"))


def test_slots_of_one_key_are_spread(spark):
    """With blocks no task has to put all slots in order; what meets in one task is summaries of blocks."""
    df = timed(spark, *[(i * 7000, "h", 1) for i in range(400)])
    text = w.sessions(df, [], "ts", 5, total(), block_slots=16)._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    single = [n for n, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert single and all("HashAggregate" in lines[n + 1] for n in single)
    assert "__block" in text
