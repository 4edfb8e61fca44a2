"""Joins on hand-made rows and against brute force."""

from __future__ import annotations

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemill.operators import joins as j
from tidemill.operators.enrich import enrich
from tidemill.sources.jdbc import RefreshingDimension


def orders(spark, *data):
    return spark.createDataFrame(data, "ms bigint, cid string, oid string, money bigint").select(
        "cid", "oid", "money", F.timestamp_millis("ms").alias("o_ts")
    )


def names(spark, *data):
    return spark.createDataFrame(data, "ms bigint, cid string, name string").select(
        "cid", "name", F.timestamp_millis("ms").alias("n_ts")
    )


def test_windowed_join_needs_the_same_window(spark):
    left = orders(spark, (1000, "c10", "o1", 2000), (31_000, "c10", "o2", 1000), (2000, "c11", "o3", 5000))
    right = names(spark, (3000, "c10", "books"), (4000, "c10", "books2"), (29_999, "c12", "x"))
    inner = j.windowed_join(left, right, ["cid"], "o_ts", "n_ts", "30 seconds")
    assert rows(inner.select("oid", "name")) == [("o1", "books"), ("o1", "books2")]
    outer = j.windowed_join(left, right, ["cid"], "o_ts", "n_ts", "30 seconds", "left")
    assert rows(outer.select("oid", "name")) == [("o1", "books"), ("o1", "books2"), ("o2", None), ("o3", None)]


def test_joined_amounts_equal_the_sum_over_pairs(spark):
    rnd = random.Random(6)
    left = orders(spark, *[(rnd.randrange(90_000), rnd.choice("hhhab"), str(n), n) for n in range(80)])
    right = names(spark, *[(rnd.randrange(90_000), rnd.choice("hhhab"), rnd.choice("xy")) for _ in range(40)])
    pairs = j.windowed_join(left, right, ["cid"], "o_ts", "n_ts", "30 seconds")
    want = pairs.groupBy("cid", "win_start", "name").agg(F.sum("money").alias("amount"), F.count("*").alias("n"))
    got = j.joined_amounts(left, right, ["cid"], "o_ts", "n_ts", "30 seconds", F.sum("money"), ["name"])
    assert rows(got.select("cid", "win_start", "name", "amount", "n_pairs")) == rows(
        want.select("cid", "win_start", "name", "amount", "n")
    )


def test_co_group_has_keys_of_both_sides(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v bigint")
    right = spark.createDataFrame([("b", 5), ("c", 6)], "k string, w bigint")
    out = j.co_group(left, right, ["k"], {"s": F.sum("v")}, {"m": F.max("w")})
    assert rows(out) == [("a", 3, None), ("b", 3, 5), ("c", None, 6)]


def test_interval_bounds(spark):
    left = orders(spark, (10_000, "c", "o", 1))
    right = names(spark, (9000, "c", "at-lower"), (9001, "c", "above-lower"), (11_000, "c", "at-upper"),
                  (11_001, "c", "beyond"), (10_000, "d", "other"))
    out = j.interval_join(left, right, ["cid"], "o_ts", "n_ts", 1, 1)
    assert rows(out.select("name")) == [("above-lower",), ("at-upper",)]


def test_interval_equals_brute_force(spark):
    rnd = random.Random(7)
    ls = [(rnd.randrange(60_000), rnd.choice("ha"), f"o{n}", n) for n in range(70)]
    rs = [(rnd.randrange(60_000), rnd.choice("ha"), f"n{n}") for n in range(70)]
    out = j.interval_join(orders(spark, *ls), names(spark, *rs), ["cid"], "o_ts", "n_ts", 2, 5)
    want = [(x[2], y[2]) for x in ls for y in rs if x[1] == y[1] and x[0] - 2000 < y[0] <= x[0] + 5000]
    assert rows(out.select("oid", "name")) == sorted(want, key=repr)


LOG = [
    ("c01", "radio", "insert", 0), ("c10", "books", "insert", 1), ("c12", "computer", "insert", 2),
    ("c12", "desktop", "update", 5), ("c01", "radio", "delete", 7),
]


@pytest.mark.parametrize("width", [1, 3, 100])
def test_changing_dimension(spark, width):
    changes = spark.createDataFrame(LOG, "cid string, name string, op string, seq bigint")
    facts = spark.createDataFrame(
        [("c01", 3), ("c12", 4), ("c12", 6), ("c01", 8), ("c99", 9), ("c10", 10)], "cid string, seq bigint"
    )
    out = j.changing_dimension(facts, changes, "cid", "seq", "name", "op", width)
    assert [(x.cid, x.seq, x.name) for x in out.orderBy("seq").collect()] == [
        ("c01", 3, "radio"), ("c12", 4, "computer"), ("c12", 6, "desktop"), ("c01", 8, None), ("c99", 9, None), ("c10", 10, "books"),
    ]


def test_lookup_keeps_unmatched_facts(spark):
    facts = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "id int, cat int")
    dim = spark.createDataFrame([(7, "x")], "cid int, name string")
    assert rows(j.lookup(facts, dim, "cat", "cid")) == [(1, 7, "x"), (2, 8, None), (3, None, None)]


def test_dimension_is_read_again_after_its_time(spark):
    now, reads = [0.0], []

    def load():
        reads.append(now[0])
        return spark.range(len(reads))

    dim = RefreshingDimension(load, ttl_seconds=600, clock=lambda: now[0])
    assert dim.current().count() == 1
    now[0] = 599.0
    assert dim.current().count() == 1
    now[0] = 600.0
    assert dim.current().count() == 2
    assert reads == [0.0, 600.0]


def test_enrich_errors_timeouts_and_order(spark):
    def ask(n):
        import time

        if n == 3:
            raise OSError("no route")
        if n == 4:
            time.sleep(1.0)
        return None if n == 5 else (f"p{n}",)

    df = spark.createDataFrame([(i, i % 7) for i in range(21)], "id bigint, n bigint").coalesce(1)
    out = enrich(df, ["n"], ask, "place string", in_flight=3, timeout_seconds=0.3).collect()
    assert [r.id for r in out] == list(range(21))
    assert {r.n: r.place for r in out} == {0: "p0", 1: "p1", 2: "p2", 3: None, 4: None, 5: None, 6: "p6"}


def test_enrich_client_per_task(spark):
    df = spark.range(4).withColumnRenamed("id", "n")
    out = enrich(df, ["n"], lambda client, n: (client[n],), "v string", open_client=lambda: {i: f"v{i}" for i in range(4)})
    assert rows(out) == [(i, f"v{i}") for i in range(4)]


def test_ip_locate_equals_join_and_overlaps_are_refused(spark):
    from tidemill.functions.udfs import ip_locate

    rules = spark.createDataFrame([(0, 9, "p0"), (20, 300, "p1")], "start_num bigint, end_num bigint, province string")
    ips = spark.createDataFrame([(f"0.0.{i // 256}.{i % 256}",) for i in range(0, 320, 5)], "ip string")
    assert rows(ip_locate(ips, "ip", rules, "province")) == rows(j.ip_lookup(ips, "ip", rules, ["province"]))
    twice = rules.union(spark.createDataFrame([(5, 25, "p2")], rules.schema))
    with pytest.raises(Exception, match="overlap"):
        j.ip_lookup(ips, "ip", twice, ["province"]).collect()


def test_own_aggregate_in_two_steps(spark):
    from tidemill.functions.udfs import two_step_sum

    df = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("b", 3, 2), ("a", 4, 3)], "k string, v bigint, seq bigint")
    assert rows(two_step_sum(df, ["k"], "v", "seq", "s", block_rows=2)) == [("a", 7), ("b", 3)]


def test_sql_functions(spark):
    from tidemill.functions.udfs import register_functions

    register_functions(spark)
    assert rows(spark.sql("SELECT word FROM split_line('hello,tom,,jerry,,')")) == [("",), ("hello",), ("jerry",), ("tom",)]
    assert rows(spark.sql("SELECT word FROM split_line('hello tom', ' ')")) == [("hello",), ("tom",)]
    assert spark.sql("SELECT ip_number('0.0.1.2') AS n").first().n == 258
    assert spark.sql("SELECT my_sum(id) AS s FROM range(5)").first().s == 10


def test_enrich_calls_share_threads(spark):
    """As many threads as calls may be in flight ask for a whole batch, not one thread a call."""
    import threading

    df = spark.range(0, 400, 1, 1).withColumnRenamed("id", "n")
    out = enrich(df, ["n"], lambda n: (f"{n}", threading.current_thread().name), "v string, t string", in_flight=5).collect()
    assert [(x.n, x.v) for x in out] == [(n, str(n)) for n in range(400)]
    assert len({x.t for x in out}) <= 5


def test_enrich_goes_on_where_all_calls_hang(spark):
    """Hung calls give null and free their places; calls behind them are still made."""
    import time

    df = spark.range(0, 12, 1, 1).withColumnRenamed("id", "n")
    slow = lambda n: time.sleep(30) if n in (0, 1, 2, 11) else (n * 10,)
    out = enrich(df, ["n"], slow, "m bigint", in_flight=2, timeout_seconds=0.3).collect()
    assert [x.m for x in out] == [None if n in (0, 1, 2, 11) else n * 10 for n in range(12)]
