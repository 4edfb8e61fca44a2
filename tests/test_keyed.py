"""State per key over several micro-batches, against batch results and plain loops."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pyarrow as pa
import pytest
from helpers import feed, rows
from pyspark.sql import functions as F

from tidemill.operators import running as r
from tidemill.operators import windows as w
from tidemill.session import run_dir
from tidemill.streaming import keyed as k
from tidemill.streaming.replay import replay, slice_bounds
from tidemill.streaming.runner import Flush, run_append, run_until_timers, without_flush

DDL = "k string, s string, v bigint, seq bigint, ts timestamp"
START = datetime(2024, 1, 1)


def data(n=90, seed=1):
    rnd = random.Random(seed)
    keys = ["h", "h", "h", "a", "b", None]
    return [(rnd.choice(keys), rnd.choice("xyz"), rnd.choice([*range(9), None]), i, START + timedelta(seconds=i * 7)) for i in range(n)]


def batches(folder):
    return len([n for n in os.listdir(f"{folder.removeprefix('file://')}/checkpoint/commits") if n.isdigit()])


@pytest.fixture
def stream(spark, tmp_path, two_partitions):
    return lambda rows_in=None, ddl=DDL, files=4: feed(spark, data() if rows_in is None else rows_in, ddl, tmp_path, files)


def run(df, name, **options):
    folder = run_dir(df.sparkSession, name)
    out = run_append(df, name, folder, **options)
    assert batches(folder) >= 3
    return out


def sums(rows_in):
    held, out = {}, {}
    for key, _, v, seq, _ in rows_in:
        held[key] = held.get(key, 0) + (v or 0)
        out[seq] = held[key]
    return out


@pytest.mark.parametrize("pack_rows", [1, 10, 1000])
def test_running_sum_in_the_stream_itself(stream, pack_rows):
    out = run(k.keyed_state(stream(), ["k"], "seq", ["v", "ts"], k.RunningSum("v"), "running bigint", pack_rows=pack_rows), "sum")
    assert {x.seq: x.running for x in out.collect()} == sums(data())
    assert rows(out.select("k", "seq", "v", "ts")) == rows(out.sparkSession.createDataFrame(data(), DDL).select("k", "seq", "v", "ts"))


def test_one_state_entry_a_key(spark, stream):
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
    folder = run_dir(spark, "entries")
    df = k.keyed_state(stream(), ["k"], "seq", ["v"], k.RunningSum("v"), "running bigint", pack_rows=7)
    query = df.writeStream.format("noop").option("checkpointLocation", folder).trigger(availableNow=True).start()
    query.awaitTermination()
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    assert [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]["numRowsTotal"] == 4


def test_rows_reach_the_key_packed(spark, tmp_path):
    """A task sends one package a key, whatever the number of its rows."""
    df = spark.createDataFrame([("h", i) for i in range(5000)], "k string, seq bigint").coalesce(1)
    assert k.packed(df, ["k"], "seq", []).count() == 1
    back = k.unpacked(k.packed(df, ["k"], "seq", []), ["k"], "seq bigint")
    assert rows(back) == rows(df)


def test_packages_of_overlapping_ranges_are_merged(spark, stream):
    """Tasks that read interleaved rows of one micro-batch: the order is still that of the sequence."""
    mixed = stream(files=3).repartition(5)
    out = run(k.keyed_state(mixed, ["k"], "seq", ["v"], k.RunningSum("v"), "running bigint", pack_rows=6), "mixed")
    assert {x.seq: x.running for x in out.collect()} == sums(data())


def test_no_keys_is_one_key(stream):
    out = run(k.keyed_state(stream(), [], "seq", ["v"], k.RunningSum("v"), "running bigint"), "all")
    assert {x.seq: x.running for x in out.collect()} == sums([(0, *d[1:]) for d in data()]) and "k" not in out.columns


def test_map_state(stream):
    out = run(k.keyed_state(stream(), ["k"], "seq", ["s", "v"], k.MapSums("s", "v"), "part bigint, total bigint"), "map")
    want = sums(data())
    parts = sums([((d[0], d[1]), *d[1:]) for d in data()])
    assert {x.seq: (x.part, x.total) for x in out.collect()} == {s: (parts[s], want[s]) for s in want}


def test_list_state(stream):
    out = run(k.keyed_state(stream(), ["k"], "seq", ["s"], k.GrowingList("s"), "items array<string>"), "list")
    held, want = {}, {}
    for key, s, _, seq, _ in data():
        held.setdefault(key, []).append(s)
        want[seq] = list(held[key])
    assert {x.seq: x["items"] for x in out.collect()} == want


def test_change_log_nets_to_the_sums(stream):
    out = run(k.keyed_state(stream(), ["k"], "seq", ["v"], k.ChangeLog("v", "total"), "total bigint, added boolean"), "log")
    plain = [(key, s, v or 0, seq, ts) for key, s, v, seq, ts in data()]
    want = r.changelog(out.sparkSession.createDataFrame(plain, DDL), ["k"], "seq", "v")
    assert rows(out.select("k", "seq", "added", "total")) == rows(want.select("k", "seq", "added", "total"))
    net = r.net_changes(out, ["k"], "total").collect()
    ends = {}
    for key, _, v, _, _ in plain:
        ends[key] = ends.get(key, 0) + v
    assert {x.k: x.total for x in net} == ends


@pytest.mark.parametrize("keys", [["k"], []])
def test_count_windows(stream, keys):
    step = k.CountWindows("v", 5)
    out = run(k.keyed_state(stream(), keys, "seq", ["v"], step, "win_no bigint, total bigint", keep=lambda c: False), "count")
    plain = out.sparkSession.createDataFrame([(*d[:2], d[2] or 0, *d[3:]) for d in data()], DDL)
    want = w.count_windows(plain, keys, "seq", 5, {"total": F.sum("v")})
    assert rows(out.select(*keys, "win_no", "total")) == rows(want.select(*keys, "win_no", "total"))


def test_rules_of_one_stream_change_what_the_other_does(stream):
    rnd, log = random.Random(3), []
    for i in range(60):
        rule = rnd.random() < 0.3
        log.append((rnd.choice("ab"), rule, rnd.choice(["p", "q", None]) if rule else None, i))
    df = stream(log, "k string, is_rule boolean, name string, seq bigint")
    step = k.LatestValue("is_rule", "name", "now")
    out = run(k.keyed_state(df, ["k"], "seq", ["is_rule", "name"], step, "now string"), "rules")
    held, want = {}, {}
    for key, rule, name, i in log:
        if rule:
            held[key] = name
        else:
            want[i] = held.get(key)
    assert {x.seq: x.now for x in out.collect()} == want


def test_event_time_timers_follow_the_watermark(spark, tmp_path, two_partitions):
    """Rows come out at the first full minute after the watermark that their micro-batch began with."""
    flush = Flush(timedelta(hours=1))
    files = 4
    table = flush.attach(feed(spark, data(), DDL, tmp_path, files), "ts").withWatermark("ts", "0 seconds")
    out = k.keyed_state(without_flush(table), ["k"], "seq", ["v"], k.HeldRowsByWatermark(), "flushed_at bigint")
    got = {x.seq: x.flushed_at for x in run(out, "timers", flush=flush).collect()}
    cuts = [len(data()) * i // files for i in range(files + 1)]
    minute = lambda ts: int((ts - datetime(1970, 1, 1)).total_seconds() * 1000) // 60_000 * 60_000 + 60_000
    want = {}
    for i in range(files):
        seen = data()[cuts[i] - 1][4] if i else datetime(1970, 1, 1)
        want.update({d[3]: minute(seen) for d in data()[cuts[i] : cuts[i + 1]]})
    assert got == want and len(set(want.values())) == files


def test_processing_time_timers(spark, tmp_path, two_partitions):
    step = k.HeldRowsByClock(1000, arrived="arrived")
    out = k.keyed_state(feed(spark, data(), DDL, tmp_path, 2), ["k"], "seq", ["v"], step, "flushed_at bigint, arrived bigint")
    got = run_until_timers(out, "clock", every_ms=1000).collect()
    assert sorted(x.seq for x in got) == [d[3] for d in data()]
    assert all(x.flushed_at == x.arrived - x.arrived % 1000 + 1000 for x in got)


def timed(n=120, seed=5):
    rnd, at, out = random.Random(seed), 0, []
    for i in range(n):
        at += rnd.choice([1, 2, 30])
        out.append((rnd.choice("hha"), rnd.choice("xy"), rnd.randrange(9), i, START + timedelta(seconds=at), at * 1000))
    return out


@pytest.mark.parametrize("sub", ["s", None])
def test_expiry_cuts_sums_and_empties_the_state(spark, tmp_path, two_partitions, sub):
    flush = Flush(timedelta(minutes=5))
    ddl = f"{DDL}, at bigint"
    base = int((START - datetime(1970, 1, 1)).total_seconds() * 1000)
    log = [(*d[:5], base + d[5]) for d in timed()]
    source = flush.attach(feed(spark, log, ddl, tmp_path, 5), "ts").withWatermark("ts", "0 seconds")
    step = k.ExpiringSums(sub, "v", "at", 20_000)
    df = k.keyed_state(without_flush(source), ["k"], "seq", ["s", "v", "at"], step, "live_sum bigint")
    got = {x.seq: x.live_sum for x in run(df, "expiry", flush=flush).collect()}
    held, want, cut = {}, {}, 0
    for key, s, v, seq, _, at in log:
        entry = (key, s if sub else "")
        total, last = held.get(entry, (0, None))
        if last is not None and at - last >= 20_000:
            total, cut = 0, cut + 1
        held[entry] = (total + v, at)
        want[seq] = total + v
    assert got == want and cut > 5


def test_items_of_a_list_expire(spark, tmp_path, two_partitions):
    flush = Flush(timedelta(minutes=5))
    base = int((START - datetime(1970, 1, 1)).total_seconds() * 1000)
    log = [(*d[:5], base + d[5]) for d in timed()]
    source = flush.attach(feed(spark, log, f"{DDL}, at bigint", tmp_path, 4), "ts").withWatermark("ts", "0 seconds")
    df = k.keyed_state(without_flush(source), ["k"], "seq", ["s", "at"], k.ExpiringList("s", "at", 20_000), "items array<string>")
    got = {x.seq: x["items"] for x in run(df, "items", flush=flush).collect()}
    held, want = {}, {}
    for key, s, _, seq, _, at in log:
        held[key] = [x for x in held.get(key, []) if x[1] + 20_000 > at] + [(s, at)]
        want[seq] = [x[0] for x in held[key]]
    assert got == want


def test_a_row_of_any_time_is_a_real_row(spark, tmp_path, two_partitions):
    flush = Flush()
    log = [("a", "x", 1, 0, START), ("a", "x", 2, 1, datetime(2200, 1, 1, 0, 0, 0, 1)), ("a", "x", 3, 2, datetime(2200, 1, 1, 0, 0, 1))]
    source = flush.attach(feed(spark, log, DDL, tmp_path, 3), "ts").withWatermark("ts", "0 seconds")
    out = run_append(k.keyed_state(without_flush(source), ["k"], "seq", ["v"], k.RunningSum("v"), "running bigint"), "far", flush=flush)
    assert sorted(x.running for x in out.collect()) == [1, 3, 6]


def test_replay_is_in_slices_of_the_order(spark):
    table = spark.createDataFrame([(i * 3, str(i)) for i in range(40)], "seq bigint, v string").repartition(4)
    folder = run_dir(spark, "replay")
    seen = []
    query = (
        replay(table, "seq", 4).writeStream.foreachBatch(lambda b, i: seen.append(sorted(x.seq for x in b.collect())))
        .option("checkpointLocation", folder).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sum(seen, []) == [i * 3 for i in range(40)] and len(seen) == 4
    assert all(low <= s[0] for low, s in zip(slice_bounds(table, "seq", 4), seen))
    assert slice_bounds(table.limit(0), "seq") == []
    assert replay(table.limit(0), "seq").isStreaming


def entries(df, path):
    """State entries at the end of a stream, by state operator."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
    query = df.writeStream.format("noop").option("checkpointLocation", path).trigger(availableNow=True).start()
    query.awaitTermination()
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return [p for p in query.recentProgress if p["numInputRows"]][-1]["stateOperators"][0]["numRowsTotal"]


def many(n=3000):
    return [("h", f"s{i % 1500}" if i % 1500 else None, i % 7, i, START + timedelta(seconds=i)) for i in range(n)]


def test_sub_keys_share_entries(spark, stream):
    """A map state takes a bounded number of calls a micro-batch, however many sub-keys come."""
    df = k.keyed_state(stream(many()), ["k"], "seq", ["s", "v"], k.MapSums("s", "v"), "part bigint, total bigint")
    got = {x.seq: (x.part, x.total) for x in run(df, "pages").collect()}
    total, parts = sums(many()), sums([(d[1], *d[1:]) for d in many()])
    assert got == {s: (parts[s], total[s]) for s in total}
    assert entries(df, run_dir(spark, "pages")) <= k.Pages.PAGES + 1


def test_expiring_sub_keys_share_entries(spark, tmp_path, two_partitions):
    base = int((START - datetime(1970, 1, 1)).total_seconds() * 1000)
    log = [(*d, base + 1000 * d[3]) for d in many()]
    source = feed(spark, log, f"{DDL}, at bigint", tmp_path, 4).withWatermark("ts", "0 seconds")
    step = k.ExpiringSums("s", "v", "at", 2_000_000)
    df = k.keyed_state(source, ["k"], "seq", ["s", "v", "at"], step, "live_sum bigint")
    got = {x.seq: x.live_sum for x in run(df, "expiring_pages").collect()}
    assert got == sums([(d[1], *d[1:]) for d in many()])
    # Beside the pages: the next expiry and its timer under both orders of keys.
    assert entries(df, run_dir(spark, "expiring_pages")) <= k.Pages.PAGES + 3


@pytest.mark.parametrize("many_keys", [False, True])
def test_packages_as_rows_and_as_frames(stream, many_keys):
    df = k.keyed_state(stream(), ["k"], "seq", ["v", "ts"], k.RunningSum("v"), "running bigint", pack_rows=7, many_keys=many_keys)
    assert {x.seq: x.running for x in run(df, "rows").collect()} == sums(data())


def test_results_are_unpacked_in_pieces():
    """One Arrow batch of many large packages isn't put together as a whole."""
    import pyarrow as pa

    inner = pa.schema([("seq", pa.int64())])
    body = pa.record_batch([pa.array(range(k.PACK_ROWS))], schema=inner).serialize().to_pybytes()
    batch = pa.record_batch([pa.array(["h"] * 5), pa.array([body] * 5)], names=["k", "pack_rows"])
    out = list(k.unpack_batches([batch], ["k"], inner))
    assert [b.num_rows for b in out] == [k.PACK_ROWS] * 5 and out[0].schema.names == ["k", "seq"]
    assert sum(b.num_rows for b in k.unpack_batches([batch.slice(0, 0)], ["k"], inner)) == 0


def test_held_rows_are_sent_one_package_after_the_other():
    import pyarrow as pa

    step, taken = k.HeldRows(), []
    step.inner = pa.schema([("seq", pa.int64())])
    body = pa.record_batch([pa.array([1, 2])], schema=step.inner).serialize().to_pybytes()

    class Buffer:
        exists, clear = staticmethod(lambda: True), staticmethod(lambda: taken.append("cleared"))
        put = staticmethod(lambda rest: taken.append([x[1] for x in rest]))

        def get(self):
            for at in (5, 9, 5):
                taken.append(at)
                yield body, at, 0

    step.buffer = Buffer()
    sent = step.due(6)
    assert next(sent).num_rows == 2 and taken == [5]
    assert len(list(sent)) == 1 and taken == [5, 9, 5, "cleared", [9]]


def test_a_growing_list_is_kept_in_pieces(spark, stream):
    """A call a micro-batch, not one an item; null is no item."""
    log = [("h", None if i % 5 == 0 else str(i), 0, i, START) for i in range(40)]
    df = k.keyed_state(stream(log), ["k"], "seq", ["s"], k.GrowingList("s"), "items array<string>", many_keys=True)
    held, want = [], {}
    for _, s, _, seq, _ in log:
        held += [s] if s else []
        want[seq] = list(held)
    assert {x.seq: x["items"] for x in run(df, "list").collect()} == want


def test_a_slice_is_in_as_many_files_as_tasks_read_the_table(spark):
    """Files of one slice hold stretches of the sequence, also of a table in one file or few."""
    table = spark.range(0, 9000, 1, 6).withColumnRenamed("id", "seq")
    stream = replay(table, "seq")
    folder = run_dir(spark, "files")
    seen = []

    def look(batch, batch_id):
        parts = batch.groupBy(F.input_file_name().alias("f")).agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count("seq").alias("n"))
        seen.append(sorted((x.a, x.b, x.n) for x in parts.collect()))

    stream.writeStream.foreachBatch(look).option("checkpointLocation", folder).trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and all(len(files) >= 6 for files in seen)
    every = sum(seen, [])
    assert all(b - a + 1 == n for a, b, n in every) and [a for a, _, _ in every[1:]] == [b + 1 for _, b, _ in every[:-1]]


def test_gaps_in_the_sequence_make_fewer_files(spark):
    table = spark.createDataFrame([(i,) for i in [0, 1, 2, 50, 51, 99]], "seq bigint").repartition(8)
    folder, seen = run_dir(spark, "gaps"), []
    replay(table, "seq", 2).writeStream.foreachBatch(lambda b, i: seen.append(sorted(x.seq for x in b.collect()))).option(
        "checkpointLocation", folder
    ).trigger(availableNow=True).start().awaitTermination()
    assert seen == [[0, 1, 2], [50, 51, 99]]


def test_timers_fire_where_the_last_batches_do_not_move_the_watermark(spark, tmp_path, two_partitions):
    """Micro-batches of equal event times: the rows of the later ones come out as well."""
    flush = Flush(timedelta(hours=1))
    log = [("a", "x", 1, i, START + timedelta(seconds=i % 10)) for i in range(30)]
    table = flush.attach(feed(spark, log, DDL, tmp_path, 3), "ts").withWatermark("ts", "0 seconds")
    out = k.keyed_state(without_flush(table), ["k"], "seq", ["v"], k.HeldRowsByWatermark(), "flushed_at bigint")
    assert sorted(x.seq for x in run(out, "equal_times", flush=flush).collect()) == list(range(30))


def test_a_larger_table_has_more_micro_batches_not_larger_ones(spark, two_partitions):
    """However unevenly the sequence is spread, rows come in order and no micro-batch has many more rows than wanted."""
    at = [*range(100), *range(10**6, 10**6 + 20)]
    seen = []
    query = replay(spark.createDataFrame([(x,) for x in at], "seq bigint").repartition(2), "seq", most_rows=30).writeStream
    query = query.foreachBatch(lambda b, i: seen.append(sorted(x.seq for x in b.collect())))
    query.option("checkpointLocation", f"{run_dir(spark, 'bounded')}/c").trigger(availableNow=True).start().awaitTermination()
    seen = [x for x in seen if x]
    assert [y for x in seen for y in x] == at and len(seen) == 4 and max(map(len, seen)) <= 31


def many_timed(n=6000, keys=4000, seed=11):
    """Rows of many keys, one of them null, whose times go on but for some that are behind."""
    rnd, at, out = random.Random(seed), 0, []
    for i in range(n):
        at += rnd.choice([0, 10, 200])
        key = rnd.choice([None, "k1", f"k{rnd.randrange(keys)}"])
        seconds = at - rnd.choice([0, 0, 5000])
        out.append((key, rnd.choice(["x", "y", None]), rnd.randrange(9), i, START + timedelta(seconds=seconds), seconds * 1000))
    return out


@pytest.mark.parametrize("kind", ["sums", "list"])
def test_many_keys_share_entries(spark, tmp_path, two_partitions, kind):
    """State entries, and so the calls of a micro-batch, don't grow with the number of keys."""
    base = int((START - datetime(1970, 1, 1)).total_seconds() * 1000)
    log = [(*d[:5], base + d[5]) for d in many_timed()]
    ttl, files = 4_000_000, 4
    source = feed(spark, log, f"{DDL}, at bigint", tmp_path, files).withWatermark("ts", "0 seconds")
    step = k.ExpiringSums(None, "v", "at", ttl, "out") if kind == "sums" else k.ExpiringList("s", "at", ttl, "out")
    adds = "out bigint" if kind == "sums" else "out array<string>"
    df = k.keyed_state(source, ["k"], "seq", ["s", "v", "at"], step, adds, many_keys=True)
    got = {x.seq: x.out for x in run(df, "shares").collect()}
    held, want, mark = {}, {}, 0
    cuts = [len(log) * i // files for i in range(files)]
    for key, s, v, seq, _, at in log:
        if seq in cuts[1:]:  # the watermark of a micro-batch has come from those before it
            mark = max(x[5] for x in log[:seq])
            held = {y: [x for x in z if x[1] + ttl > mark] for y, z in held.items()}
        if kind == "sums":
            total, last = (held.get(key) or [(0, None)])[0]
            total = v if last is None or at - last >= ttl else total + v
            held[key], want[seq] = [(total, at)], total
        else:
            held[key] = [x for x in held.get(key, []) if x[1] + ttl > at] + [(s, at)]
            want[seq] = [x[0] for x in held[key] if x[0] is not None]
    assert got == want and len(set(map(str, want.values()))) > 50
    # A page, what is known of it, and its timer under both orders of keys.
    assert entries(df, run_dir(spark, "shares")) <= 4 * k.SHARES < len({d[0] for d in log})


class Handle:
    """State and timers of one share, in memory."""

    def __init__(self):
        self.pages, self.about, self.timers = {}, None, set()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def getMapState(self, *_):
        take = lambda key: self.pages.pop(key, None)
        return SimpleNamespace(getValue=self.pages.get, updateValue=self.pages.__setitem__, removeKey=take)

    def getValueState(self, *_):
        put = lambda value: setattr(self, "about", value)
        return SimpleNamespace(get=lambda: self.about, update=put, clear=lambda: put(None))


def shared(step, columns):
    """A step of shared state as `keyed_state` sets it up, without a stream."""
    step.members, step.handle = ["pack_key_0"], Handle()
    step.inner = pa.schema([("seq", pa.int64()), (k.HASH, pa.int64()), ("pack_key_0", pa.string()), *columns])
    step.open()
    return step


def batch(step, log, now=0):
    step.begin()
    list(step.due(now))
    names = step.inner.names
    columns = [[x[0] for x in log], [hash(x[1]) for x in log], *([x[i] for x in log] for i in range(1, len(names) - 1))]
    table = pa.table({n: pa.array(c, step.inner.field(n).type) for n, c in zip(names, columns)})
    out = [x for piece in step.pieces(table, now) for x in piece.to_pylist()]
    step.end()
    return {x["seq"]: x[step.name] for x in out}


def test_pages_of_a_share_double_and_go(monkeypatch):
    monkeypatch.setattr(k, "PAGE_ROWS", 8)
    step = shared(k.ExpiringSums(None, "v", "at", 100).for_many_keys(), [("at", pa.int64()), ("v", pa.int64())])
    sums = {}
    for low in (0, 20, 300):
        got = batch(step, [(low + i, f"k{i}", low % 90, i) for i in range(low and 20 or 5)])
        for i in range(low and 20 or 5):
            sums[i] = sums.get(i, 0) + i
        assert got == {low + i: sums[i] for i in range(low and 20 or 5)}
    batch(step, [(400 + i, f"k{i}", 80, 1) for i in range(500)])
    handle = step.handle
    assert handle.about[0] >= 500 // 8 and handle.about[1] == 500 and len(handle.pages) > 32
    assert len(handle.timers) == 1 and min(handle.timers) <= 180
    assert batch(step, [(900, "k3", 179, 2)], now=120) == {900: 3 * 3 + 1 + 2}
    assert batch(step, [(901, "k3", 190, 2)], now=200) == {901: 3 * 3 + 1 + 2 + 2}
    assert handle.about[1] == 1 and len(handle.pages) == 1 and handle.timers == {290}
    step._now = lambda timerValues: 400
    assert list(step.handleExpiredTimer(None, None, None)) == []
    assert handle.pages == {} and handle.about is None and handle.timers == set()


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_lists_of_many_keys_in_pieces(monkeypatch, most):
    monkeypatch.setattr(k, "LIST_ITEMS", most)
    step = shared(k.ExpiringList("s", "at", 3000), [("at", pa.int64()), ("s", pa.string())])
    rnd, held, seq = random.Random(most), {}, 0
    for _ in range(4):
        log = [(seq + i, rnd.choice([None, "a", "b", "c"]), rnd.choice([None, *range(0, 20_000, 100)]), rnd.choice([None, "x", "y"])) for i in range(300)]
        seq, want = seq + 300, {}
        for n, key, at, s in log:
            if at is not None:
                held[key] = [x for x in held.get(key, []) if x[1] + 3000 > at] + [(s, at)]
                want[n] = [x[0] for x in held[key] if x[0] is not None]
        assert batch(step, log) == want
        assert step.handle.about[1] == sum(map(len, held.values()))


def test_a_sum_of_rows_without_a_time():
    """As in SQL, where the difference of times is null."""
    step = shared(k.ExpiringSums(None, "v", "at", 100).for_many_keys(), [("at", pa.int64()), ("v", pa.int64())])
    assert batch(step, [(0, "a", 0, 1), (1, "a", None, 2), (2, "a", 500, 4), (3, "a", 600, 8)]) == {0: 1, 1: 3, 2: 7, 3: 8}
    assert batch(step, [(4, "a", None, None)]) == {4: 8}
    assert batch(step, [(5, "a", 900, 16)], now=800) == {5: 24}


@pytest.mark.parametrize("kind", ["list", "latest"])
def test_state_of_many_keys_that_lasts(spark, tmp_path, two_partitions, kind):
    """One call a share, not one a key: also of a null key, null items and a sequence that comes unsorted."""
    rules = [True, True, False, None] if kind == "latest" else [False]
    log = [(d[0], d[1], rules[d[2] % len(rules)], d[3]) for d in many_timed()]
    source = feed(spark, log, "k string, s string, rule boolean, seq bigint", tmp_path, 4).repartition(3)
    held, want = {}, {}
    for key, s, rule, seq in log:
        if kind == "list":
            held.setdefault(key, []).extend([s] if s else [])
            want[seq] = (key, s, list(held[key]))
        elif rule:
            held[key] = s
        else:
            want[seq] = (key, s, held.get(key))
    step = k.GrowingList("s", "out") if kind == "list" else k.LatestValue("rule", "s", "out")
    adds, keep = "out array<string>" if kind == "list" else "out string", lambda c: c != "rule"
    df = k.keyed_state(source, ["k"], "seq", ["s", "rule"], step, adds, keep, many_keys=True)
    got = {x.seq: (x.k, x.s, x.out) for x in run(df, "lasting").collect()}
    assert got == want and df.columns == ["k", "seq", "s", "out"]
    assert entries(df, run_dir(spark, "lasting_entries")) <= 3 * k.SHARES < len({x[0] for x in log})


def test_growing_lists_of_a_share(monkeypatch):
    """Pages double and are split one by one; a hot key stays in one page, in the order of arrival."""
    monkeypatch.setattr(k, "PAGE_ROWS", 8)
    step = shared(k.GrowingList("s").for_many_keys(), [("s", pa.string())])
    rnd, held, seq = random.Random(5), {}, 0
    for n in (1, 40, 300, 60):
        log = [(seq + i, rnd.choice([None, "hot", f"k{rnd.randrange(90)}"]), rnd.choice([None, "", "x", "y"])) for i in range(n)]
        seq, want = seq + n, {}
        for at, key, s in log:
            held.setdefault(key, []).extend([] if s is None else [s])
            want[at] = list(held[key])
        assert batch(step, log) == want
        pages, count = step.handle.about
        assert count == sum(map(len, held.values())) <= 8 * pages and len(step.handle.pages) <= pages
    before = dict(step.handle.pages)
    assert batch(step, [(seq, "hot", None)]) == {seq: held["hot"]}
    assert step.handle.pages == before


@pytest.mark.parametrize("most", [1, 7, 1 << 20])
def test_views_are_written_out_in_pieces(monkeypatch, most):
    monkeypatch.setattr(k, "LIST_ITEMS", most)
    items, kind = pa.array(["a", "b", "c", "d", "e"]), pa.list_view(pa.string())
    views = pa.ListViewArray.from_arrays(pa.array([0, 0, 2, 0, 0], pa.int32()), pa.array([1, 0, 3, 5, 5], pa.int32()), items)
    inner = pa.schema([("seq", pa.int64()), ("out", kind)])
    body = pa.record_batch([pa.array(range(5)), views], schema=inner).serialize().to_pybytes()
    sent = pa.record_batch([pa.array(["p", "q", None]), pa.array([body] * 3)], names=["k", "pack_rows"])
    out = list(k.unpack_batches([sent], ["k"], inner))
    got = [tuple(x.values()) for b in out for x in b.to_pylist()]
    assert got == [(key, i, x) for key in ("p", "q", None) for i, x in enumerate(views.to_pylist())]
    assert all(sum(map(len, b.column("out").to_pylist())) <= max(most, 5) for b in out)
    assert all(b.schema.field("out").type == pa.list_(pa.string()) for b in out)


def test_latest_values_of_a_share(monkeypatch):
    """A rule without a value takes the earlier one back, and its entry with it; facts alone write nothing."""
    monkeypatch.setattr(k, "PAGE_ROWS", 8)
    step = shared(k.LatestValue("rule", "v", "out").for_many_keys(), [("rule", pa.bool_()), ("v", pa.int64())])
    rnd, held, seq = random.Random(7), {}, 0
    for n in (1, 200, 200, 900):
        log = [(seq + i, rnd.choice([None, "hot", f"k{rnd.randrange(90)}"]), rnd.choice([None, True, False]), rnd.choice([None, 1, 2])) for i in range(n)]
        seq, want = seq + n, {}
        for at, key, rule, v in log:
            if rule:
                held[key] = v
            else:
                want[at] = held.get(key)
        assert batch(step, log) == want
        known = sum(v is not None for v in held.values())
        assert (step.handle.about or (1, 0))[1] == known and len(step.handle.pages) <= (step.handle.about or (1, 0))[0]
    before, about = dict(step.handle.pages), step.handle.about
    assert batch(step, [(seq, "hot", False, 5), (seq + 1, "new", None, 5)]) == {seq: held["hot"], seq + 1: None}
    assert step.handle.pages == before and step.handle.about == about
    assert batch(step, [(seq + 2, key, True, None) for key in held]) == {} and step.handle.pages == {}
