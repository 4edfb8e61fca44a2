"""Time windows, session windows and count windows, on batch and streaming input.

Aggregates are given as {name: Column}.  Native aggregates are combined before
the shuffle, so a hot key or a hot window sends summaries, not rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.scans import position, running, scan_max
from tidemill.session import shared_dir


def _flat(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return df.select(
        *keys,
        F.col("window.start").cast("timestamp_ntz").alias("win_start"),
        F.col("window.end").cast("timestamp_ntz").alias("win_end"),
        *names,
    )


def tumbling(df: DataFrame, keys: list[str], ts: str, size: str, aggs: dict[str, Column]) -> DataFrame:
    """Fixed windows aligned to the epoch, closed at the start and open at the end."""
    out = df.groupBy(F.window(ts, size).alias("window"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _flat(out, keys, list(aggs))


def sliding(
    df: DataFrame, keys: list[str], ts: str, size: str, slide: str, aggs: dict[str, Column]
) -> DataFrame:
    """Overlapping windows of `size` every `slide`."""
    out = df.groupBy(F.window(ts, size, slide).alias("window"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _flat(out, keys, list(aggs))


#: How partial results of a native aggregate are put together.
_MERGES = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}


def _mergeable(aggs: dict[str, Column]) -> dict[str, Callable]:
    """The aggregate that puts partial results together, for each name."""
    merges = {}
    for name, column in aggs.items():
        call = re.match(r"Column<'(\w+)\(", str(column))
        if not call or call[1].lower() not in _MERGES:
            raise ValueError(f"{name}: only sum, count, max and min can be put together from parts")
        merges[name] = _MERGES[call[1].lower()]
    return merges


def sliding_from_panes(
    df: DataFrame,
    keys: list[str],
    ts: str,
    size: str,
    slide: str,
    sums: dict[str, Column],
) -> DataFrame:
    """Sliding sums, counts, maxima and minima over batch input, from panes of one slide each.

    Every row is aggregated once into its pane; only panes are copied into the
    `size / slide` windows that cover them.
    """
    merges = _mergeable(sums)
    panes = df.groupBy(F.window(ts, slide).alias("pane"), *keys).agg(*[c.alias(n) for n, c in sums.items()])
    wide = panes.withColumn("at", F.col("pane.start")).drop("pane")
    out = wide.groupBy(F.window("at", size, slide).alias("window"), *keys).agg(*[merges[n](n).alias(n) for n in sums])
    return _flat(out, keys, list(sums))


def streaming_sessions(df: DataFrame, keys: list[str], ts: str, gap: str, aggs: dict[str, Column]) -> DataFrame:
    """Sessions of a watermarked stream by the native session window."""
    out = df.groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return _flat(out, keys, list(aggs))


def sessions(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap_seconds: int,
    sums: dict[str, Column],
    blocked: bool | None = None,
    block_slots: int = 4096,
) -> DataFrame:
    """Sessions of batch input: a new one starts after more than `gap_seconds` of silence.

    Rows in one time slot as long as the gap always share a session, so rows are
    first combined into (key, slot); only these slots are put in order per key.
    Their number depends on the time covered, not on the number of rows.  With
    `blocked` (the default where there are no keys) even the slots of one key are
    spread: the last end and the open session are carried over blocks of slots.
    """
    merges = _mergeable(sums)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    gap = F.lit(gap_seconds * 1_000_000).cast("long")
    slots = (
        df.withColumn("__us", us)
        .groupBy(*keys, F.floor(F.col("__us") / gap).cast("long").alias("__slot"))
        .agg(F.min("__us").alias("__from"), F.max("__us").alias("__to"), *[c.alias(n) for n, c in sums.items()])
    )
    if blocked or (blocked is None and not keys):
        numbered = _numbered_by_blocks(slots, keys, gap, block_slots)
    else:
        by_slot = Window.partitionBy(*keys).orderBy("__slot")
        starts = F.when(F.col("__from") - F.lag("__to").over(by_slot) <= gap, 0).otherwise(1)
        numbered = slots.withColumn("__starts", starts).withColumn(
            "__session", F.sum("__starts").over(by_slot.rowsBetween(Window.unboundedPreceding, 0))
        )
    out = numbered.groupBy(*keys, "__session").agg(
        F.min("__from").alias("__from"), F.max("__to").alias("__to"), *[merges[n](n).alias(n) for n in sums]
    )
    return out.select(
        *keys,
        F.timestamp_micros("__from").cast("timestamp_ntz").alias("win_start"),
        F.timestamp_micros(F.col("__to") + gap).cast("timestamp_ntz").alias("win_end"),
        *sums,
    )


def _numbered_by_blocks(slots: DataFrame, keys: list[str], gap: Column, block_slots: int) -> DataFrame:
    """The slots with the start of their session, by two blocked scans: the end before each slot, then the open start.

    The slots are checkpointed, as every scan reads them more than once.
    """
    shared_dir(slots.sparkSession)
    ends = running(slots.checkpoint(), keys, "__slot", {"__before": scan_max("__to")}, block_slots, inclusive=False)
    starts = F.col("__before").isNull() | (F.col("__from") - F.col("__before") > gap)
    opened = ends.withColumn("__opens_at", F.when(starts, F.col("__from")))
    return running(opened, keys, "__slot", {"__session": scan_max("__opens_at")}, block_slots)


def with_arrival(df: DataFrame, name: str = "arrival") -> DataFrame:
    """Processing time of a stream, the same for all rows of a micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def count_windows(
    df: DataFrame, keys: list[str], seq: str, size: int, aggs: dict[str, Column], width=None
) -> DataFrame:
    """Every `size` rows of a key, in `seq` order, form a window; an unfinished rest is not emitted."""
    placed = position(df, keys, seq, "__pos", width)
    numbered = placed.withColumn("win_no", F.floor((F.col("__pos") - 1) / F.lit(size)).cast("long"))
    full = (
        numbered.groupBy(*keys, "win_no")
        .agg(F.count(F.lit(1)).alias("__n"), *[c.alias(n) for n, c in aggs.items()])
        .filter(F.col("__n") == size)
    )
    return full.drop("__n")


def top_rows(
    df: DataFrame, keys: list[str], ts: str, size: str, value: str, seq: str, n: int = 3
) -> DataFrame:
    """The `n` largest rows of each key and window; equal values keep arrival order.

    Each partition keeps only its own best `n` per group before the shuffle.
    """
    windowed = df.withColumn("win_start", F.window(ts, size).getField("start").cast("timestamp_ntz"))
    best = Window.partitionBy(*keys, "win_start").orderBy(F.col(value).desc(), F.col(seq))
    return windowed.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def history_sums(df: DataFrame, keys: list[str], ts: str, size: str, total: Column) -> DataFrame:
    """Per window: its own sum and the key's sum up to and including it."""
    per_window = tumbling(df, keys, ts, size, {"win_sum": total})
    so_far = Window.partitionBy(*keys).orderBy("win_start").rowsBetween(Window.unboundedPreceding, 0)
    return per_window.withColumn("history_sum", F.sum("win_sum").over(so_far))


@dataclass(frozen=True)
class Accumulator:
    """A window function given by mergeable parts and a finishing step."""

    parts: dict[str, Column]
    finish: Callable[[dict[str, Column]], dict[str, Column]]


def accumulate(df: DataFrame, keys: list[str], ts: str, size: str, acc: Accumulator) -> DataFrame:
    """Apply an accumulator per key and tumbling window."""
    parts = tumbling(df, keys, ts, size, acc.parts)
    results = acc.finish({name: F.col(name) for name in acc.parts})
    return parts.select(*keys, "win_start", "win_end", *[c.alias(n) for n, c in results.items()])
