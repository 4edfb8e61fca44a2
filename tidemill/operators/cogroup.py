"""Any function over both sides of a key, fed in chunks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemill.operators.scans import position

RANK, SIDE = "rank", "from_right"


class CoGroupStep:
    """What is done with one key: made anew for each, fed both sides by rising rank, then finished.

    A chunk has the rows of both sides whose ranks lie in one range, so both sides advance together and neither is held
    as a whole. Tables have the side's columns and `rank`, from 1 on without gaps.
    """

    def feed(self, left: pa.Table, right: pa.Table) -> pa.Table | None:
        raise NotImplementedError

    def finish(self) -> pa.Table | None:
        return None

    def many(self, rows: pa.Table, starts: np.ndarray) -> tuple[pa.Table, np.ndarray] | None:
        """What keys give that lie whole in `rows`, at once: results, and of each the number of its key.

        `rows` has the columns of both sides, the ranks and the side, by key, rank and side; keys begin at `starts`.
        None: keys are fed one by one.
        """
        return None


def co_group_apply(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_order: str,
    right_order: str,
    step: Callable[[], CoGroupStep],
    ddl: str,
    width=None,
) -> DataFrame:
    """Run a `step` over each key that either side has; results are the keys and the columns of `ddl`.

    The orders are whole numbers, unique within a key. Ranks come from the blocked scan; then both sides, as one tagged
    table, are shuffled once by key and sorted by rank, and each task walks through its keys chunk by chunk. A task
    holds one chunk whatever the size of a key, though a key stays in one task, since `step` may do anything.
    """
    names = [[c for c in side.columns if c not in keys] for side in (left, right)]
    if set(names[0]) & set(names[1]):
        raise ValueError(f"columns of both sides: {sorted(set(names[0]) & set(names[1]))}")
    ranked = [
        position(side, keys, order, RANK, width).withColumn(SIDE, F.lit(tag))
        for tag, (side, order) in enumerate(((left, left_order), (right, right_order)))
    ]
    both = ranked[0].unionByName(ranked[1], allowMissingColumns=True)
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, RANK, SIDE)
    inner = to_arrow_schema(StructType.fromDDL(ddl))
    kinds = dict(left.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = [None, None]  # the key at work, as a table of one row, and its step
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            # The last rank may go on in the next batch.
            cuts = _cuts(table, [*keys, RANK])
            yield from _walk(table.slice(0, cuts[-2]), now)
            rest = table.slice(cuts[-2])
        if rest is not None:
            yield from _walk(rest, now)
        if now[1] is not None:
            yield from _sent(now[0], now[1].finish())

    def _walk(table: pa.Table, now: list) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        cuts = _cuts(table, keys)
        whole = slice(cuts[1], cuts[-2]) if len(cuts) > 3 else slice(0, 0)
        inside = table.slice(whole.start, whole.stop - whole.start)
        # The first key may have begun, and the last one may go on, in another batch.
        found = step().many(inside, cuts[1:-2] - whole.start) if inside.num_rows else None
        if found is not None:
            yield from _sent(inside.select(keys).take(pa.array(cuts[1:-2] - whole.start)), *found)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if found is not None and whole.start <= a < whole.stop:
                continue
            part = table.slice(a, b - a)
            key = part.select(keys).slice(0, 1)
            if now[0] is None or not key.equals(now[0]):
                if now[1] is not None:
                    yield from _sent(now[0], now[1].finish())
                now[0], now[1] = key, step()
            from_right = part.column(SIDE).combine_chunks().to_numpy().astype(bool)
            sides = (part.filter(pa.array(mask)).select([*n, RANK]) for n, mask in zip(names, (~from_right, from_right)))
            yield from _sent(key, now[1].feed(*sides))

    def _sent(key: pa.Table, out: pa.Table | None, of: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        if out is not None and out.num_rows:
            body = out.select(inner.names).cast(inner).combine_chunks()
            again = pa.array(np.zeros(out.num_rows, np.int64) if of is None else of)
            values = [key.column(k).combine_chunks().take(again) for k in keys] + [c.combine_chunks() for c in body.columns]
            yield pa.record_batch(values, names=[*keys, *inner.names])

    return dealt.mapInArrow(run, ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), ddl]))


def _cuts(table: pa.Table, names: list[str]) -> np.ndarray:
    """Where the values of `names` change in a sorted table, with 0 in front and the length at the end."""
    change = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in names:
        codes = pc.dictionary_encode(table.column(name).combine_chunks(), null_encoding="encode").indices.to_numpy()
        change |= np.diff(codes) != 0
    return np.r_[0, np.flatnonzero(change) + 1, table.num_rows]


class PairByRank(CoGroupStep):
    """The first row of the left with the first of the right, and so on; the longer side's rest goes alone.

    `balance` is the sum of the left amounts less the right ones up to each pair.
    """

    def __init__(self, left_id: str, right_id: str, left_amount: str, right_amount: str):
        self.ids, self.amounts, self.balance = (left_id, right_id), (left_amount, right_amount), 0

    def feed(self, left, right):
        first = min(t.column(RANK)[0].as_py() for t in (left, right) if t.num_rows)
        n = max(left.num_rows, right.num_rows)
        at = [pa.array([i if i < t.num_rows else None for i in range(n)], pa.int64()) for t in (left, right)]
        amounts = [pc.fill_null(t.column(a).combine_chunks().take(i), 0).to_numpy() for t, a, i in zip((left, right), self.amounts, at)]
        sums = self.balance + np.cumsum(amounts[0] - amounts[1])
        self.balance = int(sums[-1])
        ids = {name: t.column(name).combine_chunks().take(i) for name, t, i in zip(self.ids, (left, right), at)}
        return pa.table({"pair": np.arange(first, first + n), **ids, "balance": sums})

    def many(self, rows, starts):
        """A pair is one row or the two of a rank; sums are taken over all keys, less what came before each."""
        key = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, rows.num_rows]))
        rank, from_right = rows.column(RANK).to_numpy(), rows.column(SIDE).to_numpy().astype(bool)
        first = np.flatnonzero(np.r_[True, (np.diff(key) != 0) | (np.diff(rank) != 0)])
        last = np.r_[first[1:], rows.num_rows] - 1
        change = [pc.fill_null(rows.column(a).combine_chunks(), 0).to_numpy() for a in self.amounts]
        sums = np.cumsum(np.where(from_right, -change[1], change[0]))[last]
        opens = np.flatnonzero(np.r_[True, np.diff(key[first]) != 0])
        sums = sums - np.repeat(np.r_[0, sums][opens], np.diff(np.r_[opens, len(sums)]))
        ids = {
            name: rows.column(name).combine_chunks().take(pa.array(at, mask=from_right[at] != side))
            for name, at, side in zip(self.ids, (first, last), (False, True))
        }
        return pa.table({"pair": rank[first], **ids, "balance": sums}), key[first]
