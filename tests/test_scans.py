"""The blocked scan against brute force, with hot keys, gaps, nulls and tiny blocks."""

from __future__ import annotations

import random

import pytest
from helpers import rows

from tidemill.operators.scans import (
    block_width,
    position,
    running,
    running_levels,
    scan_count,
    scan_first,
    scan_last,
    scan_max,
    scan_min,
    scan_sum,
)

DDL = "k string, seq bigint, v bigint"


def skewed(n, seed):
    """A third of the rows on one key, some null keys and values, gaps in the sequence."""
    rnd = random.Random(seed)
    seqs = rnd.sample(range(n * 3), n)
    key = lambda: "hot" if rnd.random() < 0.34 else rnd.choice(["a", "b", "c", None])
    return [(key(), s, rnd.choice([None, *range(-5, 20)])) for s in seqs]


def brute(data, inclusive=True):
    out, seen = [], {}
    for k, s, v in sorted(data, key=lambda r: r[1]):
        held = seen.setdefault(k, [])
        if inclusive:
            held.append(v)
        some = [x for x in held if x is not None]
        out.append(
            (
                k, s, v,
                sum(some) if some else None,
                max(some, default=None),
                min(some, default=None),
                some[0] if some else None,
                some[-1] if some else None,
                len(held) or None,
            )
        )
        if not inclusive:
            held.append(v)
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [1, 7, 64, 100_000])
@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_brute_force(spark, width, inclusive):
    data = skewed(300, width)
    scans = {
        "s": scan_sum("v"), "hi": scan_max("v"), "lo": scan_min("v"),
        "f": scan_first("v"), "l": scan_last("v"), "n": scan_count(),
    }
    out = running(spark.createDataFrame(data, DDL), ["k"], "seq", scans, width, inclusive)
    assert rows(out) == brute(data, inclusive)


def test_global_sequence(spark):
    data = skewed(200, 5)
    out = running(spark.createDataFrame(data, DDL), [], "seq", {"n": scan_count()}, 16)
    assert [r.n for r in out.orderBy("seq").collect()] == list(range(1, 201))


def test_levels_equal_separate_scans(spark):
    data = [(k, s % 4, s, s % 11) for s, k in enumerate(random.Random(2).choices("aaab", k=240))]
    df = spark.createDataFrame(data, "k string, c int, seq bigint, v bigint")
    both = running_levels(df, [(["k"], {"p": scan_sum("v")}), (["k", "c"], {"q": scan_max("v")})], "seq", 16)
    one = running(df, ["k"], "seq", {"p": scan_sum("v")}, 16)
    two = running(one, ["k", "c"], "seq", {"q": scan_max("v")}, 16)
    assert rows(both.select("k", "c", "seq", "p", "q")) == rows(two.select("k", "c", "seq", "p", "q"))


def test_empty_input(spark):
    df = spark.createDataFrame([], DDL)
    assert running(df, ["k"], "seq", {"s": scan_sum("v")}).collect() == []


def test_block_width_bounds_the_number_of_blocks(spark):
    def width(top):
        df = spark.createDataFrame([(0,), (top,)], "seq bigint")
        return df.select(block_width(df, "seq").alias("w")).first().w

    assert width(100) == 1024
    assert width(65536 * 5000) == 5000


def test_hot_key_is_spread_over_partitions(spark):
    """No task gets more than a fraction of a key that holds all rows."""
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("seq"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = position(df, ["k"], "seq", width=500).select("pos", F.spark_partition_id().alias("p"))
        counts = placed.groupBy("p").agg(F.count("pos").alias("n"), F.max("pos").alias("top")).collect()
        sizes = [r.n for r in counts]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20_000 and max(r.top for r in counts) == 20_000
    assert len(sizes) == 4 and max(sizes) < 10_000
