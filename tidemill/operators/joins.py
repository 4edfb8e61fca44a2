"""Joins of batch or streaming inputs.

No broadcast is forced: Catalyst broadcasts a side whose measured size is below
its threshold, and otherwise shuffles and splits skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.net import ip_number
from tidemill.operators.scans import running, scan_last


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on keys where null equals null; the right side's keys are dropped."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    return left.join(other, same, how).drop(*[f"__r_{k}" for k in keys])


def keep_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose keys occur in `wanted`."""
    return null_safe_join(df, wanted.select(*keys).distinct(), keys, "left_semi")


def _window_start(ts: str, size: str) -> Column:
    return F.window(ts, size).getField("start")


def windowed_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    size: str,
    how: str = "inner",
) -> DataFrame:
    """Rows with equal keys in the same tumbling window; `how` is inner or left."""
    on = [*keys, "win_start"]
    lhs = left.withColumn("win_start", _window_start(left_ts, size).cast("timestamp_ntz"))
    rhs = right.withColumn("win_start", _window_start(right_ts, size).cast("timestamp_ntz"))
    return lhs.join(rhs, on, how)


def joined_amounts(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    size: str,
    amount: Column,
    names: list[str],
) -> DataFrame:
    """Sum of the left amounts over the windowed inner join, per key, window and `names` of the right side.

    Both sides are aggregated before they meet: a left sum counts once for each
    right row, so no pair is ever built.
    """
    lhs = (
        left.withColumn("win_start", _window_start(left_ts, size).cast("timestamp_ntz"))
        .groupBy(*keys, "win_start")
        .agg(amount.alias("__amount"), F.count(F.lit(1)).alias("__left"))
    )
    rhs = (
        right.withColumn("win_start", _window_start(right_ts, size).cast("timestamp_ntz"))
        .groupBy(*keys, "win_start", *names)
        .agg(F.count(F.lit(1)).alias("__right"))
    )
    return lhs.join(rhs, [*keys, "win_start"]).select(
        *keys,
        "win_start",
        *names,
        (F.col("__amount") * F.col("__right")).alias("amount"),
        (F.col("__left") * F.col("__right")).alias("n_pairs"),
    )


def co_group(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_aggs: dict[str, Column],
    right_aggs: dict[str, Column],
) -> DataFrame:
    """Both sides of every key, each reduced by its own mergeable aggregates.

    A key that only one side has gets null for the other.  Each side is combined
    before its shuffle; what is joined is one row per key.
    """
    lhs = left.groupBy(*keys).agg(*[c.alias(n) for n, c in left_aggs.items()])
    rhs = right.groupBy(*keys).agg(*[c.alias(n) for n, c in right_aggs.items()])
    return lhs.join(rhs, keys, "full")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    below_seconds: int,
    above_seconds: int,
) -> DataFrame:
    """Inner join on keys with `left - below < right <= left + above`.

    Time is cut into slots as long as the interval; a left row asks for the one
    or two slots its interval touches.  The join is then an equality on key and
    slot, and a hot key is spread over its slots.
    """
    below, above = below_seconds * 1_000_000, above_seconds * 1_000_000
    size = F.lit(below + above).cast("long")

    def slot(us: Column) -> Column:
        return (us - F.pmod(us, size)) / size

    lhs_us = F.unix_micros(F.col(left_ts).cast("timestamp"))
    rhs_us = F.unix_micros(F.col(right_ts).cast("timestamp"))
    lhs = left.withColumn("__left_us", lhs_us).withColumn(
        "__slot",
        F.explode(
            F.sequence(
                slot(F.col("__left_us") - below + 1).cast("long"), slot(F.col("__left_us") + above).cast("long")
            )
        ),
    )
    rhs = right.withColumn("__right_us", rhs_us).withColumn("__slot", slot(F.col("__right_us")).cast("long"))
    near = (F.col("__right_us") > F.col("__left_us") - below) & (F.col("__right_us") <= F.col("__left_us") + above)
    return lhs.join(rhs, [*keys, "__slot"]).filter(near).drop("__slot", "__left_us", "__right_us")


def ip_lookup(
    df: DataFrame, ip: str, rules: DataFrame, names: list[str], shift: int = 16, how: str = "left"
) -> DataFrame:
    """The rule whose [start_num, end_num] holds the address, null if none.

    A rule is listed under every block of 2^shift addresses it touches, so the
    join is an equality on the block and the range is checked within it.  Rules
    that overlap stop the query: an address would have two answers.
    """
    listed = rules.withColumn(
        "__block",
        F.explode(F.sequence(F.shiftright("start_num", shift), F.shiftright("end_num", shift))),
    ).select("__block", "start_num", "end_num", *names)
    # Rules that overlap meet in some block.
    before = Window.partitionBy("__block").orderBy("start_num", "end_num").rowsBetween(Window.unboundedPreceding, -1)
    overlap = F.max("end_num").over(before) >= F.col("start_num")
    listed = listed.withColumn(
        "start_num", F.when(overlap, F.raise_error(F.lit("address rules overlap")).cast("bigint")).otherwise(F.col("start_num"))
    )
    asked = df.withColumn("__ip", ip_number(ip)).withColumn("__block_asked", F.shiftright("__ip", shift))
    hit = (F.col("__block") == F.col("__block_asked")) & F.col("__ip").between(
        F.col("start_num"), F.col("end_num")
    )
    return asked.join(listed, hit, how).drop("__ip", "__block_asked", "__block", "start_num", "end_num")


def lookup(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Left join to a dimension with one row per key; facts without a match stay."""
    return facts.join(dimension, facts[fact_key] == dimension[dim_key], "left").drop(dim_key)


def changing_dimension(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    seq: str,
    name: str,
    op: str,
    width=None,
) -> DataFrame:
    """Give every fact the name its key had when it arrived, null if none or deleted.

    Facts and changes are put in one arrival order and the latest change is
    carried forward by the blocked scan.  No fact meets more than one version,
    and a hot key's facts are spread over its blocks.
    """
    version = F.struct(F.when(F.col(op) != "delete", F.col(name)).alias("name"))
    log = changes.select(key, seq, version.alias("__version"))
    both = facts.withColumn("__fact", F.lit(True)).unionByName(log, allowMissingColumns=True)
    seen = running(both, [key], seq, {"__now": scan_last("__version")}, width)
    return seen.filter("__fact").withColumn(name, F.col("__now.name")).drop("__fact", "__version", "__now")
