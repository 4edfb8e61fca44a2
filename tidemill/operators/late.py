"""Late rows: judged row by row against the event times seen before them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.scans import running, scan_max


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def mark_late(
    df: DataFrame,
    ts: str,
    seq: str,
    size_seconds: int,
    delay_seconds: int = 0,
    width=None,
    seen_before: int | None = None,
) -> DataFrame:
    """Add `is_late`: the row's window was already over when the row arrived.

    The watermark before a row is the largest event time that arrived earlier,
    minus the delay; a window is over when it has reached its last millisecond.
    `seen_before` is the largest event time (epoch microseconds) of earlier
    batches.  The watermark comes from the blocked scan over the whole arrival
    order, so there is no single task that sees all rows.
    """
    size = F.lit(size_seconds * 1_000_000).cast("long")
    timed = df.withColumn("__us", _micros(ts))
    seen = running(timed, [], seq, {"__seen": scan_max("__us")}, width, inclusive=False)
    mark = F.col("__seen")
    if seen_before is not None:
        mark = F.greatest(mark, F.lit(seen_before).cast("long"))
    last_ms = F.col("__us") - F.pmod(F.col("__us"), size) + size - 1000
    late = F.coalesce(last_ms <= mark - delay_seconds * 1_000_000, F.lit(False))
    return seen.withColumn("is_late", late).drop("__us", "__seen")


def split_late(df: DataFrame, *args, **kwargs) -> tuple[DataFrame, DataFrame]:
    """(rows on time, late rows)."""
    marked = mark_late(df, *args, **kwargs)
    return (
        marked.filter(~F.col("is_late")).drop("is_late"),
        marked.filter("is_late").drop("is_late"),
    )
