"""Running (prefix) aggregates over an ordered sequence, safe for hot keys.

A plain `agg().over(partitionBy(key).orderBy(seq))` sorts all rows of a key in
one task.  Here keys with more rows than a block are found first, and their
sequence is cut into blocks of a fixed width:

1. every (hot key, block) is pre-aggregated, with map-side combine;
2. these few summaries are carried forward over the blocks of a key;
3. each (key, block) is scanned on its own, opened by one row that holds what
   the earlier blocks contributed.

The rows themselves are shuffled once, as for the plain window, but a hot key's
rows are spread over as many tasks as it has blocks; other keys stay whole.  A
hot key holds more than 1/65,536 of all rows, so there are fewer than 65,536 of
them, and the list of their hashes (half a megabyte at most) is safe to broadcast.  `seq` must be a unique integer per
key, so a block never holds more rows of a key than its width.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_BLOCK = 1024
MAX_BLOCKS = 65536

_BLOCK = "__block"
_HOT = "__hot"
_OPENS = "__opens"


@dataclass(frozen=True)
class Scan:
    """What is accumulated: a per-row value and an associative operation on it."""

    value: Column
    op: str

    def group(self, name: str, seq: str) -> Column:
        col = F.col(name)
        present = F.when(col.isNotNull(), F.col(seq))
        return {
            "sum": lambda: F.sum(col),
            "max": lambda: F.max(col),
            "min": lambda: F.min(col),
            "first": lambda: F.min_by(col, present),
            "last": lambda: F.max_by(col, present),
        }[self.op]()

    def over(self, name: str, window) -> Column:
        col = F.col(name)
        agg = {
            "sum": lambda: F.sum(col),
            "max": lambda: F.max(col),
            "min": lambda: F.min(col),
            "first": lambda: F.first(col, ignorenulls=True),
            "last": lambda: F.last(col, ignorenulls=True),
        }[self.op]()
        return agg.over(window)


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def scan_sum(value) -> Scan:
    return Scan(_column(value), "sum")


def scan_count() -> Scan:
    return Scan(F.lit(1).cast("long"), "sum")


def scan_max(value) -> Scan:
    return Scan(_column(value), "max")


def scan_min(value) -> Scan:
    return Scan(_column(value), "min")


def scan_first(value) -> Scan:
    """First non-null value so far."""
    return Scan(_column(value), "first")


def scan_last(value) -> Scan:
    """Latest non-null value so far."""
    return Scan(_column(value), "last")


def block_width(df: DataFrame, seq: str) -> Column:
    """A width giving at most about 65,536 blocks, as a one-row subquery of the plan."""
    span = df.agg((F.max(seq) - F.min(seq)).alias("span")).scalar()
    return F.greatest(F.lit(MIN_BLOCK).cast("long"), F.ceil(span / F.lit(MAX_BLOCKS)).cast("long"))


def block_start(seq: str, width) -> Column:
    """First sequence value of the block `seq` falls in."""
    width = F.lit(width).cast("long") if isinstance(width, int) else width
    return F.col(seq) - F.pmod(F.col(seq), width)


def _blocked(df: DataFrame, keys: list[str], seq: str, width) -> DataFrame:
    """Add the block of each row, null for keys that fit into one block."""
    width = F.lit(width).cast("long") if isinstance(width, int) else width
    start = block_start(seq, width)
    if not keys:
        return df.withColumn(_BLOCK, start)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.sum("__n").alias("total")).scalar()
    limit = F.greatest(width, F.ceil(total / F.lit(MAX_BLOCKS)).cast("long"))
    # A hash stands for the key, so the list has 8 bytes an entry however wide keys are.  A key that shares a hot
    # key's hash is only cut into blocks as well.
    hot = counts.filter(F.col("__n") > limit).select(F.xxhash64(*keys).alias("__hot_key")).distinct()
    hot = hot.withColumn(_HOT, F.lit(True))
    return (
        df.join(F.broadcast(hot), F.xxhash64(*keys) == F.col("__hot_key"), "left")
        .withColumn(_BLOCK, F.when(F.col(_HOT), start))
        .drop(_HOT, "__hot_key")
    )


def running(
    df: DataFrame,
    keys: list[str],
    seq: str,
    scans: dict[str, Scan],
    width=None,
    inclusive: bool = True,
) -> DataFrame:
    """Add one running aggregate per entry of `scans`, in `seq` order within `keys`.

    With `inclusive=False` the row itself is left out, so the first row of a key
    gets null.  No keys means one global sequence.
    """
    return running_ordered(df, keys, seq, [F.col(seq)], scans, width, inclusive)


def running_ordered(
    df: DataFrame,
    keys: list[str],
    seq: str,
    order: list[Column],
    scans: dict[str, Scan],
    width=None,
    inclusive: bool = True,
) -> DataFrame:
    """`running` for a finer order: blocks are cut on `seq`, rows sorted by `order`.

    `order` must agree with `seq` and start with an ascending column without
    nulls.  Rows equal in `seq` share a block, so here
    the width bounds a block's span, not its rows.
    """
    if width is None:
        width = block_width(df, seq)
    lifted = {name: f"__scan_{name}" for name in scans}
    rows = _blocked(df, keys, seq, width).withColumns({lifted[n]: s.value for n, s in scans.items()})

    summaries = rows.filter(F.col(_BLOCK).isNotNull()).groupBy(*keys, _BLOCK).agg(
        *[s.group(lifted[n], seq).alias(lifted[n]) for n, s in scans.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    openers = (
        summaries.select(*keys, _BLOCK, *[s.over(lifted[n], earlier).alias(lifted[n]) for n, s in scans.items()])
        .filter(_any_present(lifted.values()))
        .withColumn(_OPENS, F.lit(True))
    )

    last = 0 if inclusive else -1
    within = (
        Window.partitionBy(*keys, _BLOCK)
        .orderBy(*order)  # an opening row has no position, and null sorts first
        .rowsBetween(Window.unboundedPreceding, last)
    )
    both = rows.withColumn(_OPENS, F.lit(False)).unionByName(openers, allowMissingColumns=True)
    return (
        both.select("*", *[s.over(lifted[n], within).alias(n) for n, s in scans.items()])
        .filter(~F.col(_OPENS))
        .drop(_BLOCK, _OPENS, *lifted.values())
    )


def running_levels(
    df: DataFrame,
    levels: list[tuple[list[str], dict[str, Scan]]],
    seq: str,
    width=None,
) -> DataFrame:
    """Running sums, maxima or minima for keys that extend each other, coarsest first.

    All levels share one shuffle of the rows, on the coarsest keys and the block,
    and one pass of pre-aggregation, on the finest keys.
    """
    if width is None:
        width = block_width(df, seq)
    scans = {name: scan for _, own in levels for name, scan in own.items()}
    lifted = {name: f"__scan_{name}" for name in scans}
    rows = _blocked(df, levels[0][0], seq, width).withColumns({lifted[n]: s.value for n, s in scans.items()})

    finest = levels[-1][0]
    summaries = rows.filter(F.col(_BLOCK).isNotNull()).groupBy(*finest, _BLOCK).agg(
        *[s.group(lifted[n], seq).alias(lifted[n]) for n, s in scans.items()]
    )
    both = rows.withColumn(_OPENS, F.lit(False))
    for keys, own in levels:
        rolled = summaries
        if keys != finest:
            rolled = summaries.groupBy(*keys, _BLOCK).agg(
                *[s.group(lifted[n], _BLOCK).alias(lifted[n]) for n, s in own.items()]
            )
        earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        openers = (
            rolled.select(*keys, _BLOCK, *[s.over(lifted[n], earlier).alias(lifted[n]) for n, s in own.items()])
            .filter(_any_present([lifted[n] for n in own]))
            .withColumn(_OPENS, F.lit(True))
        )
        both = both.unionByName(openers, allowMissingColumns=True)

    for keys, own in levels:
        within = (
            Window.partitionBy(*keys, _BLOCK)
            .orderBy(F.col(seq))
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        both = both.select("*", *[s.over(lifted[n], within).alias(n) for n, s in own.items()])
    return both.filter(~F.col(_OPENS)).drop(_BLOCK, _OPENS, *lifted.values())


def _any_present(names) -> Column:
    test = F.lit(False)
    for name in names:
        test = test | F.col(name).isNotNull()
    return test


def position(df: DataFrame, keys: list[str], seq: str, name: str = "pos", width=None) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... in `seq` order."""
    return running(df, keys, seq, {name: scan_count()}, width)
