"""Keyed aggregations: final values, one value per input row, and change logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.scans import (
    Scan,
    block_width,
    position,
    running,
    running_ordered,
    scan_count,
    scan_first,
    scan_max,
    scan_min,
    scan_sum,
)
from tidemill.session import shared_dir

REDUCERS = {"sum": scan_sum, "max": scan_max, "min": scan_min}


def keyed_reduce(df: DataFrame, keys: list[str], value: str, op: str = "sum", name: str | None = None) -> DataFrame:
    """Final value per key; combined before the shuffle."""
    return df.groupBy(*keys).agg(getattr(F, op)(value).alias(name or value))


def running_reduce(
    df: DataFrame, keys: list[str], seq: str, value: str, op: str = "sum", name: str = "running", width=None
) -> DataFrame:
    """The reduced value after every row."""
    return running(df, keys, seq, {name: REDUCERS[op](value)}, width)


def running_max_keep_first(
    df: DataFrame, keys: list[str], seq: str, value: str, others: list[str], width=None
) -> DataFrame:
    """Running maximum whose other fields stay those of the key's first row."""
    scans: dict[str, Scan] = {f"max_{value}": scan_max(value)}
    scans["__first"] = scan_first(F.struct(*others))
    out = running(df, keys, seq, scans, width)
    return out.withColumns({f"first_{c}": F.col(f"__first.{c}") for c in others}).drop("__first")


def _ranked(df: DataFrame, value: str, seq: str, first: bool) -> Column:
    order = -F.col(seq) if first else F.col(seq)
    return F.struct(F.col(value).alias("v"), order.alias("o"), F.struct("*").alias("row"))


def max_row(df: DataFrame, keys: list[str], value: str, seq: str, first: bool = True) -> DataFrame:
    """The whole row with the largest value per key; ties go to the first or the latest row."""
    best = df.select(*keys, _ranked(df, value, seq, first).alias("best")).groupBy(*keys).agg(F.max("best").alias("best"))
    return best.select(*[F.col(f"best.row.{c}").alias(c) for c in df.columns])


def running_max_row(
    df: DataFrame, keys: list[str], value: str, seq: str, first: bool = True, width=None
) -> DataFrame:
    """After every row (its `seq` kept as `at_seq`), the row with the largest value so far."""
    best = df.select(*keys, F.col(seq).alias("at_seq"), _ranked(df, value, seq, first).alias("cand"))
    out = running(best, keys, "at_seq", {"best": scan_max("cand")}, width)
    return out.select("at_seq", *[F.col(f"best.row.{c}").alias(c) for c in df.columns])


def distinct_counts(df: DataFrame, keys: list[str], member: str, approximate: bool = False) -> DataFrame:
    """Rows and distinct members per key.

    The exact form first reduces to one row per (key, member), so a hot key is
    spread over its members.
    """
    if approximate:
        return df.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct(member).alias("n_members")
        )
    pairs = df.groupBy(*keys, member).agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy(*keys).agg(F.sum("n").alias("n_rows"), F.count(member).alias("n_members"))


def running_distinct_counts(
    df: DataFrame, keys: list[str], member: str, seq: str, width=None
) -> DataFrame:
    """Rows and distinct members per key after every row.

    A member counts at its first row.  One pre-aggregated group-by finds that
    place, and a mark there goes into the same scan as the rows, in front of the
    row it belongs to: no row is joined, and rows are shuffled once.
    """
    marks = (
        df.filter(F.col(member).isNotNull())
        .groupBy(*keys, member)
        .agg(F.min(seq).alias(seq))
        .select(*keys, seq, F.lit(0).cast("long").alias("__row"), F.lit(1).cast("long").alias("__new"))
    )
    rows = df.withColumns({"__row": F.lit(1).cast("long"), "__new": F.lit(0).cast("long")})
    both = rows.unionByName(marks, allowMissingColumns=True)
    scans = {"n_rows": scan_sum("__row"), "n_members": scan_sum("__new")}
    width = block_width(df, seq) if width is None else width
    out = running_ordered(both, keys, seq, [F.col(seq), F.col("__row")], scans, width)
    return out.filter(F.col("__row") == 1).drop("__row", "__new")


def paged_history(
    df: DataFrame, keys: list[str], seq: str, value: str, page_rows: int = 64, width=None
) -> DataFrame:
    """A growing list per key, after every row.

    A whole list per row would grow with the square of the key's rows.  So each
    row holds `pos`, its place in the key's list, and `page_items`, the items of
    its own page up to it; the full list is the last row of each earlier page
    followed by `page_items`.  Lists up to one page are complete in each row.
    """
    placed = position(df, keys, seq, "pos", width).withColumn(
        "page", F.floor((F.col("pos") - 1) / F.lit(page_rows)).cast("long")
    )
    so_far = Window.partitionBy(*keys, "page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("page_items", F.collect_list(value).over(so_far))


def full_history(paged: DataFrame, keys: list[str], name: str = "items") -> DataFrame:
    """The whole list after every row of `paged_history`: the full earlier pages, then the row's own.

    The output grows with the square of a key's rows, as the lists themselves do.
    """
    ends = paged.groupBy(*keys, "page").agg(F.max_by("page_items", "pos").alias("__page"))
    earlier = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys],
        F.col("page").alias("__of_page"),
        F.flatten(F.collect_list("__page").over(earlier)).alias("__earlier"),
    )
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in [*keys, "page"]]
    out = paged.join(ends, same).withColumn(name, F.concat("__earlier", "page_items"))
    return out.drop("__earlier", *[f"__of_{k}" for k in [*keys, "page"]])


def changelog(df: DataFrame, keys: list[str], seq: str, value: str, name: str = "total", width=None) -> DataFrame:
    """Running sum as a change log: the old total is taken back, the new one added.

    The sum of `name` over added minus removed rows of a key is its final total.
    """
    present = F.col(value).isNotNull().cast("long")
    scans = {"__new": scan_sum(value), "__pos": scan_count(), "__present": scan_sum(present)}
    sums = running(df, keys, seq, scans, width)
    # Null adds nothing; before the first value that is not null the total is null.
    before = F.when(F.col("__present") > present, F.col("__new") - F.coalesce(value, F.lit(0)))
    old = F.struct(F.lit(False).alias("added"), before.alias(name))
    new = F.struct(F.lit(True).alias("added"), F.col("__new").alias(name))
    changes = F.when(F.col("__pos") == 1, F.array(new)).otherwise(F.array(old, new))
    return sums.select(*keys, seq, F.explode(changes).alias("c")).select(*keys, seq, "c.*")


def net_changes(log: DataFrame, keys: list[str], *values: str, added: str = "added") -> DataFrame:
    """What is left of a change log: rows that were added once more than they were taken back.

    Counts are combined before the shuffle, and rows that cancel out inside a task are never sent.
    """
    net = log.groupBy(*keys, *values).agg(F.sum(F.when(F.col(added), 1).otherwise(-1)).alias("__net"))
    return net.filter(F.col("__net") != 0).drop("__net")


def expiring_sum(df: DataFrame, keys: list[str], seq: str, at_ms: str, value: str, ttl_ms: int, width=None) -> DataFrame:
    """Running sum whose state is forgotten `ttl_ms` after its last write.

    `at_ms` is the arrival time, not falling in `seq` order.  A row that comes
    `ttl_ms` or more after the one before it starts anew; the plain running total
    in front of the last such start is taken off.  The first scan's result is
    checkpointed, as the second one reads it twice.
    """
    shared_dir(df.sparkSession)
    earlier = {"__prev": scan_max(at_ms), "__before": scan_sum(value)}
    totals = running(df, keys, seq, earlier, width, inclusive=False).checkpoint()
    restart = F.col("__prev").isNull() | (F.col(at_ms) - F.col("__prev") >= ttl_ms)
    before = F.coalesce("__before", F.lit(0))
    start = F.when(restart, F.struct(F.col(seq).alias("s"), before.alias("b")))
    out = running(totals.withColumn("__at_start", start), keys, seq, {"__start": scan_max("__at_start")}, width)
    return out.withColumn("live_sum", before + F.coalesce(value, F.lit(0)) - F.col("__start.b")).drop(
        "__prev", "__before", "__at_start", "__start"
    )


def expiring_list(df: DataFrame, keys: list[str], seq: str, at_ms: str, ttl_ms: int, width=None) -> DataFrame:
    """Elements of a list with expiry that are alive after every row.

    The live elements are always a run of positions of the key's list, so each
    row gets its `pos` and `first_live`; `live_items` expands them.  Elements
    expired before this row are counted by a second scan over expiry marks.
    """
    adds = df.select(*keys, F.col(at_ms).alias("__at"), F.lit(0).alias("__kind"), F.col(seq).alias("__seq"))
    ends = df.select(*keys, (F.col(at_ms) + ttl_ms).alias("__at"), F.lit(1).alias("__kind"), F.col(seq).alias("__seq"))
    # Order of time; an expiry mark comes before an arrival at the same instant.
    marks = adds.unionByName(ends).withColumns(
        {"__n": (F.col("__kind") == 1).cast("long"), "__a": (F.col("__kind") == 0).cast("long")}
    )
    timed = _running_by_time(marks, keys, {"__gone": scan_sum("__n"), "pos": scan_sum("__a")})
    live = timed.filter(F.col("__kind") == 0).select(
        *keys, F.col("__seq").alias(seq), "pos", (F.col("__gone") + 1).alias("first_live")
    )
    return live.withColumn("n_live", F.col("pos") - F.col("first_live") + 1)


def _running_by_time(marks: DataFrame, keys: list[str], scans: dict[str, Scan]) -> DataFrame:
    """A blocked scan ordered by (time, expiry first, seq); blocks are cut in time."""
    order = [F.col("__at"), F.col("__kind").desc(), F.col("__seq")]
    return running_ordered(marks, keys, "__at", order, scans)


def live_items(live: DataFrame, items: DataFrame, keys: list[str], value: str, chunk: int = 256) -> DataFrame:
    """Each live element once per row of `expiring_list`.

    `items` has the keys, `pos` and `value`.  Rows ask for whole chunks of
    positions, so the join is an equality and a key spreads over its chunks.
    """
    asks = live.withColumn(
        "__chunk",
        F.explode(F.sequence(F.floor(F.col("first_live") / chunk), F.floor(F.col("pos") / chunk))),
    ).withColumnRenamed("pos", "at_pos")
    held = items.select(*keys, "pos", value, F.floor(F.col("pos") / chunk).alias("__chunk"))
    return (
        asks.join(held, [*keys, "__chunk"])
        .filter(F.col("pos").between(F.col("first_live"), F.col("at_pos")))
        .drop("__chunk")
    )
