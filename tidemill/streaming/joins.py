"""Stream-stream joins.

Left rows get one of `salts` numbers, right rows every one of them, so the state
and the rows of a hot key are spread over that many tasks.  Each left row still
meets each right row of its key exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _salted(left: DataFrame, right: DataFrame, unique: str, salts: int) -> tuple[DataFrame, DataFrame]:
    lhs = left.withColumn("__salt", F.pmod(F.xxhash64(F.col(unique)), F.lit(salts)).cast("int"))
    rhs = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return lhs, rhs


def _on(lhs: DataFrame, rhs: DataFrame, keys: list[str]) -> tuple[DataFrame, list]:
    names = [*keys, "__salt"]
    other = rhs.withColumnsRenamed({k: f"__r_{k}" for k in names})
    return other, [F.col(k) == F.col(f"__r_{k}") for k in names]


def stream_windowed_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    size: str,
    unique: str,
    how: str = "inner",
    delay: str = "0 seconds",
    salts: int = 8,
) -> DataFrame:
    """Rows with equal keys in the same tumbling window.

    A left row without a match comes out, for how="left", once the watermark has
    passed its window.
    """
    lhs, rhs = _salted(left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay), unique, salts)
    lhs = lhs.withColumn("win", F.window(left_ts, size))
    rhs = rhs.withColumn("__r_win", F.window(right_ts, size))
    rhs, same = _on(lhs, rhs, keys)
    same.append(F.col("win") == F.col("__r_win"))
    out = lhs.join(rhs, same, how)
    start = F.col("win.start").cast("timestamp_ntz")
    return out.withColumn("win_start", start).drop("win", "__r_win", "__salt", "__r___salt", *[f"__r_{k}" for k in keys])


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    below: str,
    above: str,
    unique: str,
    delay: str = "0 seconds",
    salts: int = 8,
) -> DataFrame:
    """Inner join with `left - below < right <= left + above`; old rows leave the state with the watermark."""
    lhs, rhs = _salted(left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay), unique, salts)
    rhs, same = _on(lhs, rhs, keys)
    near = (F.col(right_ts) > F.col(left_ts) - F.expr(f"interval {below}")) & (
        F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {above}")
    )
    out = lhs.join(rhs, [*same, near], "inner")
    return out.drop("__salt", "__r___salt", *[f"__r_{k}" for k in keys])
