"""Streams equal batch whatever the cut into micro-batches; restart, expiry, timers, late drops."""

from __future__ import annotations

import random
import time

import pytest
from helpers import feed, rows
from pyspark.sql import functions as F

from tidemill.operators import joins as j
from tidemill.operators import running as r
from tidemill.operators import windows as w
from tidemill.operators.late import mark_late
from tidemill.session import run_dir
from tidemill.sinks.upsert import UpsertTable
from tidemill.streaming import carried, runner
from tidemill.streaming import state as s
from tidemill.streaming.joins import stream_interval_join, stream_windowed_join

DDL = "k string, v bigint, seq bigint, ts timestamp"


def data(n=60, seed=1):
    from datetime import datetime, timedelta

    rnd, start = random.Random(seed), datetime(2024, 1, 1)
    return [(rnd.choice("hhhab"), rnd.randrange(10), i, start + timedelta(seconds=i * 3)) for i in range(n)]


FILES = pytest.mark.parametrize("files", [1, 3, 10])


@FILES
def test_running_sum(spark, tmp_path, files):
    df = spark.createDataFrame(data(), DDL)
    out = carried.stream_running_sum(feed(spark, data(), DDL, tmp_path, files), ["k"], "seq", "v")
    want = r.running_reduce(df, ["k"], "seq", "v")
    assert rows(out.select("k", "seq", "running")) == rows(want.select("k", "seq", "running"))


@FILES
def test_late_marks(spark, tmp_path, files):
    from datetime import timedelta

    late = [(k, v, q, t - timedelta(seconds=40) if q % 7 == 0 else t) for k, v, q, t in data()]
    out = carried.stream_split_late(feed(spark, late, DDL, tmp_path, files), "ts", "seq", 10)
    want = mark_late(spark.createDataFrame(late, DDL), "ts", "seq", 10)
    assert rows(out.select("seq", "is_late")) == rows(want.select("seq", "is_late"))
    assert want.filter("is_late").count() > 3


@FILES
def test_changing_dimension(spark, tmp_path, files):
    ddl = "seq bigint, k string, name string, op string"
    rnd = random.Random(8)
    log = [
        (i, rnd.choice("hhab"), f"n{i}", rnd.choice(["insert", "update", "delete"])) if i % 4 == 0
        else (i, rnd.choice("hhab"), None, None)
        for i in range(50)
    ]
    out = carried.stream_changing_dimension(feed(spark, log, ddl, tmp_path, files), "k", "seq", "name", "op")
    df = spark.createDataFrame(log, ddl)
    want = j.changing_dimension(df.filter("op is null").drop("name", "op"), df.filter("op is not null"), "k", "seq", "name", "op")
    assert rows(out.select("seq", "k", "name")) == rows(want.select("seq", "k", "name"))


@FILES
def test_windows(spark, tmp_path, files):
    flush = runner.Flush()
    stream = flush.attach(feed(spark, data(), DDL, tmp_path, files), "ts").withWatermark("ts", "0 seconds")
    out = runner.run_append(w.tumbling(stream, ["k"], "ts", "10 seconds", {"n": F.sum("v")}), "t", flush=flush)
    assert rows(out) == rows(w.tumbling(spark.createDataFrame(data(), DDL), ["k"], "ts", "10 seconds", {"n": F.sum("v")}))


@pytest.mark.parametrize("files", [1, 3])
def test_sessions(spark, tmp_path, files):
    flush = runner.Flush()
    stream = flush.attach(feed(spark, data(), DDL, tmp_path, files), "ts").withWatermark("ts", "0 seconds")
    out = runner.run_append(w.streaming_sessions(stream, ["k"], "ts", "6 seconds", {"n": F.sum("v")}), "s", flush=flush)
    assert rows(out) == rows(w.sessions(spark.createDataFrame(data(), DDL), ["k"], "ts", 6, {"n": F.sum("v")}))


@pytest.mark.parametrize("files", [1, 3])
def test_value_state(spark, tmp_path, files, two_partitions):
    out = runner.run_append(s.state_sum(feed(spark, data(), DDL, tmp_path, files), ["k"], "seq", "v", block_rows=16), "v")
    got = s.resolve_sum(out, ["k"], "v")
    want = r.running_reduce(spark.createDataFrame(data(), DDL), ["k"], "seq", "v")
    assert rows(got.select("k", "seq", "running")) == rows(want.select("k", "seq", "running"))


@pytest.mark.parametrize("files", [3])
def test_map_state(spark, tmp_path, files, two_partitions):
    rows_in = [(k, str(v % 3), v, q) for k, v, q, _ in data()]
    ddl = "p string, c string, v bigint, seq bigint"
    out = runner.run_append(s.state_map_sum(feed(spark, rows_in, ddl, tmp_path, files), ["p"], "c", "seq", "v", block_rows=16), "m")
    both = s.resolve_sum(s.resolve_sum(out, ["p"], "v", "block_sum", "total"), ["p", "c"], "v", "sub_sum", "part")
    df = spark.createDataFrame(rows_in, ddl)
    want = r.running_reduce(r.running_reduce(df, ["p"], "seq", "v", name="total"), ["p", "c"], "seq", "v", name="part")
    assert rows(both.select("seq", "total", "part")) == rows(want.select("seq", "total", "part"))


@pytest.mark.parametrize("files", [3])
def test_list_state(spark, tmp_path, files, two_partitions):
    rows_in = [(k, f"e{q}", q) for k, v, q, _ in data()]
    out = runner.run_append(s.state_list(feed(spark, rows_in, "k string, e string, seq bigint", tmp_path, files), ["k"], "seq", "e", page_rows=16), "l")
    pages, want = {}, {}
    for k, e, q in rows_in:
        pages.setdefault((k, q // 16), []).append(e)
        want[q] = ",".join(pages[(k, q // 16)])
    assert {x.seq: x.items for x in out.collect()} == want


def test_whole_lists_of_the_list_state(spark, tmp_path, two_partitions):
    rows_in = [(k, "" if q == 3 else f"e{q}", q) for k, v, q, _ in data()]
    out = runner.run_append(s.state_list(feed(spark, rows_in, "k string, e string, seq bigint", tmp_path, 3), ["k"], "seq", "e", page_rows=7), "l")
    lists, want = {}, {}
    for k, e, q in rows_in:
        lists.setdefault(k, []).append(e)
        want[q] = ",".join(lists[k])
    assert {x.seq: x["items"] for x in s.resolve_list(out, ["k"], "seq").collect()} == want


def run_two_batches(df, column):
    """Expiry keeps a stream going without input, so it runs until both rows are out and is stopped."""
    got = []

    def write(batch, batch_id):
        new = [(x.seq, x[column]) for x in batch.collect()]
        got.extend(new)
        if new:
            time.sleep(1.0)

    folder = run_dir(df.sparkSession, "ttl")
    query = df.writeStream.foreachBatch(write).option("checkpointLocation", folder).trigger(processingTime="100 milliseconds").start()
    try:
        give_up = time.monotonic() + 60
        while len(got) < 2 and time.monotonic() < give_up and query.isActive:
            time.sleep(0.2)
    finally:
        query.stop()
    return sorted(got)


def test_value_state_expires(spark, tmp_path, two_partitions):
    """Two micro-batches further apart than the expiry: the second starts anew."""
    stream = feed(spark, [("a", 1, 0), ("a", 2, 1)], "k string, v bigint, seq bigint", tmp_path, 2)
    assert run_two_batches(s.state_sum(stream, ["k"], "seq", "v", ttl_ms=500), "block_sum") == [(0, 1), (1, 2)]


def test_list_state_expires(spark, tmp_path, two_partitions):
    stream = feed(spark, [("a", "x", 0), ("a", "y", 1)], "k string, e string, seq bigint", tmp_path, 2)
    assert run_two_batches(s.state_list(stream, ["k"], "seq", "e", ttl_ms=500), "items") == [(0, "x"), (1, "y")]


def test_map_state_expires(spark, tmp_path, two_partitions):
    stream = feed(spark, [("a", "c", 1, 0), ("a", "c", 2, 1)], "k string, c string, v bigint, seq bigint", tmp_path, 2)
    sums = s.state_map_sum(stream, ["k"], "c", "seq", "v", ttl_ms=500, refresh_on_read=True)
    assert run_two_batches(sums, "sub_sum") == [(0, 1), (1, 2)]


def test_native_watermark_drops_late_rows(spark, tmp_path):
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    at = [0, 25, 26, 27, 1]
    late = [("a", 1, i, start + timedelta(seconds=x)) for i, x in enumerate(at)]
    stream = feed(spark, late, DDL, tmp_path, 5).withWatermark("ts", "0 seconds")
    query = (
        w.tumbling(stream, ["k"], "ts", "10 seconds", {"n": F.sum("v")}).writeStream.format("noop")
        .option("checkpointLocation", run_dir(spark, "drop")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"]) == 1


@pytest.mark.parametrize("how", ["inner", "left"])
def test_windowed_join(spark, tmp_path, how):
    left = [(k, v, q, t) for k, v, q, t in data(40, 2)]
    right = [(k, v, q, t) for k, v, q, t in data(40, 3)]
    ls, rs = "k string, lv bigint, lid bigint, lts timestamp", "k string, rv bigint, rid bigint, rts timestamp"
    (tmp_path / "l").mkdir()
    (tmp_path / "r").mkdir()
    flush = runner.Flush()
    lstream = flush.attach(feed(spark, left, ls, tmp_path / "l", 3), "lts", k="-1")
    rstream = flush.attach(feed(spark, right, rs, tmp_path / "r", 3), "rts", k="-2")
    out = runner.run_append(
        stream_windowed_join(lstream, rstream, ["k"], "lts", "rts", "10 seconds", "lid", how).select("k", "lid", "rid"), "j", flush=flush
    )
    want = j.windowed_join(spark.createDataFrame(left, ls), spark.createDataFrame(right, rs), ["k"], "lts", "rts", "10 seconds", how)
    assert rows(out) == rows(want.select("k", "lid", "rid"))


def test_interval_join(spark, tmp_path):
    left, right = data(40, 2), data(40, 3)
    ls, rs = "k string, lv bigint, lid bigint, lts timestamp", "k string, rv bigint, rid bigint, rts timestamp"
    (tmp_path / "l").mkdir()
    (tmp_path / "r").mkdir()
    out = stream_interval_join(
        feed(spark, left, ls, tmp_path / "l", 3), feed(spark, right, rs, tmp_path / "r", 3), ["k"], "lts", "rts", "6 seconds", "6 seconds", "lid",
        delay="1 hour",
    )
    got = runner.run_append(out.select("lid", "rid"), "i")
    want = j.interval_join(spark.createDataFrame(left, ls), spark.createDataFrame(right, rs), ["k"], "lts", "rts", 6, 6)
    assert rows(got) == rows(want.select("lid", "rid"))


def test_processing_time_window_of_a_stream(spark, tmp_path):
    arrived = w.with_arrival(feed(spark, data(), DDL, tmp_path, 2))
    out = w.tumbling(arrived, ["k"], "arrival", "1 hour", {"n": F.sum("v")})
    got = runner.run_upsert(out, "pt", ["k", "win_start", "win_end"])
    assert got.agg(F.sum("n")).first()[0] == sum(d[1] for d in data())


def test_upsert_table_bases_and_replay(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), "k string, v bigint", ["k"], base_every=2)
    assert table.read().collect() == []
    for n in range(6):
        table.merge(spark.createDataFrame([("a", n), (f"k{n}", n)], "k string, v bigint"), n)
    table.merge(spark.createDataFrame([("a", 50), ("k5", 5)], "k string, v bigint"), 5)
    assert dict(rows(table.read())) == {"a": 50, **{f"k{n}": n for n in range(6)}}
    assert dict(rows(table.read(before=3))) == {"a": 2, "k0": 0, "k1": 1, "k2": 2}
    assert {x.batch_id for x in table.log().collect()} == {4, 5}


def test_running_sum_survives_a_failure_between_write_and_commit(spark, tmp_path, monkeypatch):
    """The second micro-batch writes, fails, and is replayed after a restart."""
    stream = feed(spark, data(), DDL, tmp_path, 4)
    folder, real, failed = run_dir(spark, "fail"), UpsertTable.merge, []

    def merge(self, batch, batch_id):
        real(self, batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(1)
            raise RuntimeError("planned failure")

    monkeypatch.setattr(UpsertTable, "merge", merge)
    with pytest.raises(Exception, match="planned failure"):
        carried.stream_running_sum(stream, ["k"], "seq", "v", folder=folder)
    out = carried.stream_running_sum(stream, ["k"], "seq", "v", folder=folder)
    want = r.running_reduce(spark.createDataFrame(data(), DDL), ["k"], "seq", "v")
    assert rows(out.select("k", "seq", "running")) == rows(want.select("k", "seq", "running"))


def test_exactly_once_files_after_a_failure(spark, tmp_path):
    """A stream stopped by a bad record goes on from its checkpoint without losing or repeating rows."""
    ddl = "line string"
    stream = feed(spark, [("a",), ("b",), ("error x",), ("c",)], ddl, tmp_path, 4)
    folder = run_dir(spark, "once")
    from tidemill.operators.rows import guard

    with pytest.raises(Exception, match="error record"):
        runner.run_append(guard(stream, F.col("line").startswith("error"), "error record"), "once", folder)
    out = runner.run_append(stream.filter(~F.col("line").startswith("error")), "once", folder)
    assert rows(out) == [("a",), ("b",), ("c",)]


def test_upsert_source_has_as_many_files_as_tasks_read(spark, folder, tmp_path):
    """No file of the folder that the stream reads grows with the documents; it still takes three micro-batches."""
    import glob

    from tidemill.plans import aggregates  # noqa: F401
    from tidemill.plans.registry import QUERIES
    from tidemill.session import shared_dir

    spark.read.parquet(f"{folder}/documents.parquet").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    base = f"{shared_dir(spark).removeprefix('file://')}/tidemill"
    before = set(glob.glob(f"{base}/upsert*"))
    got = QUERIES["snk_upsert"](spark, str(tmp_path))
    source, run = sorted(set(glob.glob(f"{base}/upsert*")) - before, key=lambda p: "source" not in p)
    assert len(glob.glob(f"{source}/part-*")) >= 8
    assert len([c for c in glob.glob(f"{run}/checkpoint/commits/*") if c.rsplit("/", 1)[1].isdigit()]) == 3
    assert got.exceptAll(QUERIES["word_count"](spark, folder)).count() == 0
