"""Keyed state, expiry and timers as stateful processors.

State is kept per key and block of the arrival order (or per key and salt where
order does not matter), so one key's rows and state are spread over tasks and a
processor never holds more rows of a key than a block has.  `resolve_*` then
adds what earlier blocks hold, which turns block values into values of the key.

Expiry (`ttl_ms`) counts processing time and keeps a stream going when no input
comes, so such a stream runs on an interval trigger, not to an end.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemill.operators.joins import null_safe_join
from tidemill.operators.scans import block_start, running, scan_sum

BLOCK_ROWS = 4096
PAGE_ROWS = 1024


def _one(name: str, kind) -> StructType:
    """A one-field schema; built by hand, since processors start where no session is."""
    return StructType([StructField(name, kind)])


def _in_order(rows: Iterator[pd.DataFrame], seq: str) -> pd.DataFrame:
    """The block's rows of this micro-batch by arrival; at most one block of them."""
    return pd.concat(list(rows), ignore_index=True).sort_values(seq, kind="stable", ignore_index=True)


class _Processor(StatefulProcessor):
    def __init__(self, columns: list[str], seq: str, ttl_ms: int | None = None):
        self.columns, self.seq, self.ttl_ms = columns, seq, ttl_ms

    def close(self) -> None:
        pass


class SumState(_Processor):
    """A value state with the sum of `value`; one output per row."""

    def __init__(self, columns, seq, value, ttl_ms=None):
        super().__init__(columns, seq, ttl_ms)
        self.value = value

    def init(self, handle) -> None:
        self.total = handle.getValueState("total", _one("total", LongType()), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, self.seq)
        held = self.total.get() if self.total.exists() else None
        batch["block_sum"] = batch[self.value].cumsum() + (held[0] if held else 0)
        self.total.update((int(batch["block_sum"].iloc[-1]),))
        yield batch[self.columns]


class MapSumState(_Processor):
    """A map state with one sum per sub-key; one output per row with its sub-key's sum and the sum of all."""

    def __init__(self, columns, seq, sub_key, value, ttl_ms=None, refresh_on_read=False):
        super().__init__(columns, seq, ttl_ms)
        self.sub_key, self.value, self.refresh_on_read = sub_key, value, refresh_on_read

    def init(self, handle) -> None:
        self.sums = handle.getMapState(
            "sums", _one("k", StringType()), _one("total", LongType()), self.ttl_ms
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, self.seq)
        held = {k[0]: v[0] for k, v in self.sums.iterator()}
        if self.refresh_on_read:
            # Expiry counts from the last write, so a read that renews it writes back.
            for sub_key, total in held.items():
                self.sums.updateValue((sub_key,), (total,))
        before = batch[self.sub_key].map(lambda k: held.get(k, 0)).astype("int64")
        batch["sub_sum"] = batch.groupby(self.sub_key)[self.value].cumsum() + before
        batch["block_sum"] = batch[self.value].cumsum() + sum(held.values())
        for sub_key, total in batch.groupby(self.sub_key)["sub_sum"].last().items():
            self.sums.updateValue((sub_key,), (int(total),))
        yield batch[self.columns]


class ListState(_Processor):
    """A list state of `item`; one output per row with the list up to it, joined by commas."""

    def __init__(self, columns, seq, item, ttl_ms=None):
        super().__init__(columns, seq, ttl_ms)
        self.item = item

    def init(self, handle) -> None:
        self.items = handle.getListState("items", _one("item", StringType()), self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = _in_order(rows, self.seq)
        held = [v[0] for v in self.items.get()] if self.items.exists() else []
        lists = []
        for item in batch[self.item]:
            held.append(item)
            lists.append(",".join(held))
        batch["items"] = lists
        self.items.appendList([(item,) for item in batch[self.item]])
        yield batch[self.columns]


def _apply(df: DataFrame, group: list[str], processor: _Processor, ddl: str, time_mode: str) -> DataFrame:
    return df.groupBy(*group).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=StructType.fromDDL(ddl),
        outputMode="Append",
        timeMode=time_mode,
    )


def _typed(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def _mode(ttl_ms: int | None) -> str:
    return "ProcessingTime" if ttl_ms else "None"


def state_sum(
    df: DataFrame, keys: list[str], seq: str, value: str, ttl_ms: int | None = None, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Value state: per row the sum of its key and block so far (`block_sum`)."""
    rows = df.select(*keys, seq, value).withColumn("block", block_start(seq, block_rows))
    ddl = f"{_typed(rows, [*keys, seq, value, 'block'])}, block_sum bigint"
    processor = SumState([*keys, seq, value, "block", "block_sum"], seq, value, ttl_ms)
    return _apply(rows, [*keys, "block"], processor, ddl, _mode(ttl_ms))


def resolve_sum(out: DataFrame, keys: list[str], value: str, local: str = "block_sum", name: str = "running") -> DataFrame:
    """Add the sums of earlier blocks of the key.

    `out` is the table a stream wrote; there is one total per key and block, and
    they are carried by a blocked scan of their own.
    """
    totals = out.groupBy(*keys, "block").agg(F.sum(value).alias("__total"))
    before = running(totals, keys, "block", {"__before": scan_sum("__total")}, inclusive=False).drop("__total")
    joined = null_safe_join(out, before, [*keys, "block"])
    return joined.withColumn(name, F.col(local) + F.coalesce("__before", F.lit(0))).drop("__before")


def state_map_sum(
    df: DataFrame,
    keys: list[str],
    sub_key: str,
    seq: str,
    value: str,
    ttl_ms: int | None = None,
    block_rows: int = BLOCK_ROWS,
    refresh_on_read: bool = False,
) -> DataFrame:
    """Map state: per row the block's sum of its sub-key (`sub_sum`) and of all (`block_sum`)."""
    rows = df.select(*keys, sub_key, seq, value).withColumn("block", block_start(seq, block_rows))
    columns = [*keys, sub_key, seq, value, "block"]
    ddl = f"{_typed(rows, columns)}, sub_sum bigint, block_sum bigint"
    processor = MapSumState([*columns, "sub_sum", "block_sum"], seq, sub_key, value, ttl_ms, refresh_on_read)
    return _apply(rows, [*keys, "block"], processor, ddl, _mode(ttl_ms))


def state_list(
    df: DataFrame, keys: list[str], seq: str, item: str, ttl_ms: int | None = None, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """List state: per row the items of its key and page so far; earlier pages are complete lists."""
    rows = df.select(*keys, seq, item).withColumn("page", block_start(seq, page_rows))
    columns = [*keys, seq, "page"]
    ddl = f"{_typed(rows, columns)}, items string"
    processor = ListState([*columns, "items"], seq, item, ttl_ms)
    return _apply(rows, [*keys, "page"], processor, ddl, _mode(ttl_ms))


def resolve_list(out: DataFrame, keys: list[str], seq: str, name: str = "items") -> DataFrame:
    """Put the full lists of earlier pages of the key before the row's own.

    `out` is the table a stream wrote by `state_list`. It grows with the square
    of a key's rows, as the lists themselves do.
    """
    ends = out.groupBy(*keys, "page").agg(F.max_by("items", seq).alias("__page"))
    earlier = Window.partitionBy(*keys).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "page", F.collect_list("__page").over(earlier).alias("__earlier"))
    joined = null_safe_join(out, ends, [*keys, "page"])
    return joined.withColumn(name, F.concat_ws(",", "__earlier", "items")).drop("__earlier")
