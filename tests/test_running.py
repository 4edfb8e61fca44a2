"""Keyed aggregations on hand-computed examples."""

from __future__ import annotations

import random

from helpers import rows
from pyspark.sql import functions as F

from tidemill.operators import running as r
from tidemill.operators.scans import running_levels, scan_sum

PAIRS = [("spark", 1, 0), ("hadoop", 3, 1), ("spark", 2, 2), ("hadoop", 5, 3)]
PAIR = "word string, cnt bigint, seq bigint"


def pairs(spark, data=PAIRS):
    return spark.createDataFrame(data, PAIR)


def test_running_sum_emits_one_value_per_row(spark):
    for width in (1, 1000):
        out = r.running_reduce(pairs(spark), ["word"], "seq", "cnt", width=width)
        assert [(x.word, x.running) for x in out.orderBy("seq").collect()] == [
            ("spark", 1), ("hadoop", 3), ("spark", 3), ("hadoop", 8),
        ]


def test_final_reduce(spark):
    assert rows(r.keyed_reduce(pairs(spark), ["word"], "cnt")) == [("hadoop", 8), ("spark", 3)]
    assert rows(r.keyed_reduce(pairs(spark), ["word"], "cnt", "max")) == [("hadoop", 5), ("spark", 2)]


def test_running_max_keeps_other_fields_of_first_row(spark):
    data = [("a", 5, 0), ("a", 2, 1), ("a", 9, 2)]
    out = r.running_max_keep_first(pairs(spark, data), ["word"], "seq", "cnt", ["seq"], width=1)
    assert rows(out.select("seq", "max_cnt", "first_seq")) == [(0, 5, 0), (1, 5, 0), (2, 9, 0)]


MONEY = [
    ("辽宁省", "沈阳市", 2000, 0), ("山东省", "济南市", 2000, 1), ("山东省", "烟台市", 3000, 2),
    ("辽宁省", "本溪市", 1000, 3), ("辽宁省", "大连市", 2000, 4),
]


def test_max_row_and_ties(spark):
    df = spark.createDataFrame(MONEY, "province string, city string, money bigint, seq bigint")
    first = r.max_row(df, ["province"], "money", "seq", first=True)
    last = r.max_row(df, ["province"], "money", "seq", first=False)
    assert dict(rows(first.select("province", "city"))) == {"辽宁省": "沈阳市", "山东省": "烟台市"}
    assert dict(rows(last.select("province", "city"))) == {"辽宁省": "大连市", "山东省": "烟台市"}
    so_far = r.running_max_row(df, ["province"], "money", "seq", first=False, width=2)
    assert [(x.at_seq, x.city) for x in so_far.orderBy("at_seq").collect()] == [
        (0, "沈阳市"), (1, "济南市"), (2, "烟台市"), (3, "沈阳市"), (4, "大连市"),
    ]


def test_income(spark):
    data = [
        ("河北省", "保定市", 3000), ("河北省", "廊坊市", 2000), ("河北省", "保定市", 2000),
        ("辽宁省", "沈阳市", 1000), ("辽宁省", "大连市", 2000), ("辽宁省", "大连市", 2000),
    ]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "p string, c string, m bigint, seq bigint")
    out = running_levels(df, [(["p"], {"total": scan_sum("m")}), (["p", "c"], {"part": scan_sum("m")})], "seq", 2)
    got = [(x.p, x.total, x.c, x.part) for x in out.orderBy("seq").collect()]
    assert got == [
        ("河北省", 3000, "保定市", 3000), ("河北省", 5000, "廊坊市", 2000), ("河北省", 7000, "保定市", 5000),
        ("辽宁省", 1000, "沈阳市", 1000), ("辽宁省", 3000, "大连市", 2000), ("辽宁省", 5000, "大连市", 4000),
    ]


def test_distinct_counts(spark):
    data = [("a1", "view", "u1", 0), ("a1", "view", "u2", 1), ("a1", "view", "u1", 2), ("a1", "click", "u1", 3), ("a1", "view", None, 4)]
    df = spark.createDataFrame(data, "ad string, event string, uid string, seq bigint")
    assert rows(r.distinct_counts(df, ["ad", "event"], "uid")) == [("a1", "click", 1, 1), ("a1", "view", 4, 2)]
    assert rows(r.distinct_counts(df, ["ad", "event"], "uid", approximate=True)) == [("a1", "click", 1, 1), ("a1", "view", 4, 2)]
    out = r.running_distinct_counts(df, ["ad", "event"], "uid", "seq", width=2)
    assert [(x.n_rows, x.n_members) for x in out.orderBy("seq").collect()] == [(1, 1), (2, 2), (3, 2), (1, 1), (4, 2)]


def test_history_pages_rebuild_the_growing_list(spark):
    data = [("u1" if i % 3 else "u2", f"e{i}", i) for i in range(40)]
    df = spark.createDataFrame(data, "uid string, event string, seq bigint")
    out = r.paged_history(df, ["uid"], "seq", "event", page_rows=4, width=5).orderBy("seq").collect()
    grown, pages = {}, {}
    for row in out:
        grown.setdefault(row.uid, []).append(row.event)
        pages.setdefault(row.uid, {})[row.page] = list(row.page_items)
        assert len(row.page_items) <= 4
        assert sum(pages[row.uid].values(), []) == grown[row.uid]


def test_changelog_nets_to_the_final_sum(spark):
    log = r.changelog(pairs(spark), ["word"], "seq", "cnt", width=1)
    assert rows(log.filter("word = 'spark'").select("added", "total", "seq"), "seq", "added") == [
        (True, 1, 0), (False, 1, 2), (True, 3, 2),
    ]
    net = log.groupBy("word").agg(F.sum(F.when(F.col("added"), F.col("total")).otherwise(-F.col("total"))).alias("n"))
    assert rows(net) == [("hadoop", 8), ("spark", 3)]


def test_expiring_sum(spark):
    data = [("a", 0, 0, 1), ("a", 1, 29, 2), ("a", 2, 59, 4), ("a", 3, 70, 8), ("b", 4, 71, 16)]
    df = spark.createDataFrame(data, "k string, seq bigint, at bigint, v bigint")
    for width in (1, 100):
        out = r.expiring_sum(df, ["k"], "seq", "at", "v", 30, width)
        assert [x.live_sum for x in out.orderBy("seq").collect()] == [1, 3, 4, 12, 16]


def test_expiring_list_against_brute_force(spark):
    rnd = random.Random(3)
    at, data = 0, []
    for seq in range(120):
        at += rnd.choice([0, 1, 5, 20])
        data.append((rnd.choice("aab"), seq, at))
    df = spark.createDataFrame(data, "k string, seq bigint, at bigint")
    live = r.expiring_list(df, ["k"], "seq", "at", 30)
    want = {s: [x[1] for x in data if x[0] == k and x[1] <= s and x[2] + 30 > t] for k, s, t in data}
    assert {x.seq: x.n_live for x in live.collect()} == {s: len(v) for s, v in want.items()}
    items = live.select("k", "pos", F.col("seq").alias("item"))
    listed = {}
    for x in r.live_items(live, items, ["k"], "item", chunk=4).collect():
        listed.setdefault(x.seq, []).append(x.item)
    assert {s: sorted(v) for s, v in listed.items()} == want
