"""Row-wise operators on hand-made lines."""

from __future__ import annotations

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemill.functions.net import check_rules, ip_number
from tidemill.functions.text import split_trimmed, tokens, words
from tidemill.operators import keys
from tidemill.operators import rows as r
from tidemill.operators.iterate import iterate_until
from tidemill.operators.joins import ip_lookup


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "line string")


@pytest.mark.parametrize(
    "line, want",
    [
        ("a b", ["a", "b"]),
        ("a  b  ", ["a", "", "b"]),
        ("", [""]),
        ("   ", []),
        (" a", ["", "a"]),
        (None, None),
    ],
)
def test_tokens(spark, line, want):
    df = lines(spark, line)
    got = df.select(tokens("line").alias("t")).first().t
    assert got == want


def test_tokens_null_line_gives_no_words(spark):
    assert rows(words(lines(spark, None, "x y"), "line")) == [("x",), ("y",)]


@pytest.mark.parametrize(
    "line, sep, want",
    [("a,b,,", ",", ["a", "b"]), ("", ",", [""]), (",,", ",", []), ("a1b22c", "[0-9]+", ["a", "b", "c"])],
)
def test_split_trimmed(spark, line, sep, want):
    assert lines(spark, line).select(split_trimmed("line", sep).alias("t")).first().t == want


PAIR = "word string, cnt int"


def test_parse_fail_stops_at_a_malformed_number(spark):
    assert rows(r.parse_delimited(lines(spark, "spark,1", "hadoop,3"), "line", PAIR)) == [("hadoop", 3), ("spark", 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        r.parse_delimited(lines(spark, "spark,x"), "line", PAIR).collect()
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        r.parse_delimited(lines(spark, "spark"), "line", PAIR).collect()


def test_parse_other_modes(spark):
    df = lines(spark, "spark,1", "hive,x", "short")
    assert rows(r.parse_delimited(df, "line", PAIR, on_error="drop")) == [("spark", 1)]
    assert rows(r.parse_delimited(df, "line", PAIR, on_error="null")) == [("hive", None), ("short", None), ("spark", 1)]
    bad = r.parse_delimited(df, "line", PAIR, on_error="quarantine").filter("bad_line is not null")
    assert rows(bad.select("bad_line")) == [("hive,x",), ("short",)]
    with pytest.raises(ValueError):
        r.parse_delimited(df, "line", PAIR, on_error="guess")


def test_json_good_and_quarantined(spark):
    df = lines(spark, '{"name":"tom","age":18,"fv":99.9}', '{"name":"jerry","age":18', '{"name":"x","age":"old"}')
    good, bad = r.json_split(df, "line", "name string, age int, fv double")
    assert rows(good) == [("tom", 18, 99.9)]
    assert bad.count() == 2


def test_guard(spark):
    assert r.guard(lines(spark, "a", "b"), F.col("line").startswith("error"), "bad").count() == 2
    with pytest.raises(Exception, match="bad record"):
        r.guard(lines(spark, "a", "error 1"), F.col("line").startswith("error"), "bad record").collect()


def test_filters(spark):
    df = lines(spark, "error 1", "ok", None, "error")
    assert rows(r.without_prefix(df, "line", "error")) == [("ok",)]
    assert rows(r.without_value(df, "line", "error")) == [("error 1",), ("ok",), (None,)]


def test_side_tags(spark):
    out = r.tag_numbers(lines(spark, "1", "2", "abc", "-3", "99999999999"), "line")
    assert dict(rows(out.select("line", "tag"))) == {
        "1": "odd", "2": "even", "abc": "str", "-3": "odd", "99999999999": "str",
    }
    sides = r.routes(out, "tag", ["odd", "even", "str"])
    assert {k: v.count() for k, v in sides.items()} == {"odd": 2, "even": 1, "str": 2}


def test_positions_and_union_keeps_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    assert r.at_positions(df, 2, 1).columns == ["z", "y"]
    assert r.union_all(df, df, df).count() == 3


def test_iterate(spark):
    df = spark.createDataFrame([(10,), (3,), (-5,), (100,)], "n bigint")
    out = iterate_until(df, "n", lambda v: v - 3, lambda v: v > 0, steps_per_round=4)
    assert rows(out) == [(-2,), (-2,), (-8,), (0,)]
    far = iterate_until(spark.createDataFrame([(2000,), (5,)], "n bigint"), "n", lambda v: v - 1, lambda v: v > 0)
    assert rows(far) == [(0,), (0,)]


def test_distribution(spark):
    df = spark.range(100)

    def sizes(out):
        return [r[1] for r in sorted(rows(out.groupBy(F.spark_partition_id().alias("p")).count()))]

    even = sizes(keys.rebalance(df, 5))
    assert len(even) == 5 and max(even) - min(even) <= 5
    assert keys.rescale(df, 2, current=8).rdd.getNumPartitions() == 2
    assert keys.rescale(df, 9, current=8).rdd.getNumPartitions() == 9
    assert len(sizes(keys.replicate(spark.range(3), 4))) == 4
    assert sizes(keys.replicate(spark.range(3), 4)) == [3] * 4
    assert sorted(r.id for r in keys.shuffled(df, 3, "id").collect()) == list(range(100))


def test_first_letter_partition(spark):
    df = spark.createDataFrame([("hive",), ("flume",), ("spark",), ("other",)], "w string")
    number = keys.first_letter_partition("w", {"h": 1, "f": 2, "s": 3})
    out = keys.partition_by_id(df, 4, number).select("w", F.spark_partition_id())
    assert dict(rows(out)) == {"hive": 1, "flume": 2, "spark": 3, "other": 0}


def test_concat_key_collides_where_two_columns_do_not(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    assert df.groupBy(keys.concat_key("a", "b")).count().count() == 1
    assert df.groupBy(*keys.key_columns(df, [0, "b"])).count().count() == 2


def test_ip(spark):
    assert lines(spark, "106.121.4.252").select(ip_number("line").alias("n")).first().n == 1786316028
    assert spark.range(1).select(ip_number(F.lit("1.2.3.4")).alias("n")).first().n == ((1 * 256 + 2) * 256 + 3) * 256 + 4


def test_ip_lookup_boundaries_and_overlap(spark):
    rules = spark.createDataFrame(
        [(0, 9, "p0"), (10, 300_000, "p1"), (400_000, 400_000, "p2")], "start_num bigint, end_num bigint, province string"
    )
    ips = {"0.0.0.0": "p0", "0.0.0.9": "p0", "0.0.0.10": "p1", "0.4.147.224": "p1", "0.4.147.225": None, "0.6.26.128": "p2"}
    for shift in (4, 16):
        out = ip_lookup(lines(spark, *ips), "line", rules, ["province"], shift)
        assert dict(rows(out)) == ips
    assert check_rules(rules).count() == 0
    overlapping = rules.unionByName(spark.createDataFrame([(5, 20, "x")], rules.schema))
    assert check_rules(overlapping).count() == 2
