"""State per key on a stream, in two levels.

One state entry a key is what a keyed stream means, but one row a call would send all rows of a hot key through one
task, row by row. Here the rows of a key that a task reads are first put together, in arrival order, into one packed
row: an Arrow batch as bytes. This needs no shuffle, like the combining side of an aggregate. Only packed rows go to
the task of the key. It holds the key's state, takes the packages in order, works on whole columns, and sends packed
results, which any task unpacks. So a micro-batch's rows of the hottest key pass one task as a few hundred byte arrays,
and state is one entry a key whatever the number of rows.

Where keys are many and their rows few, the calls of a key cost more than its rows. Steps of shared state take the keys
of a share, dealt by their hash, together: rows of all of them are worked on at once, and a page of state has many keys.
Each key still has its own value or list, its own last write and its own expiry.

`seq` is the arrival order, unique within a key. Packages of tasks that read overlapping ranges of it are merged.
Between micro-batches the order is that of the batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

#: Rows that a task puts together before it sends a package for each of their keys.
PACK_ROWS = 1 << 16
#: Shares that keys are dealt to by a step of shared state. It is part of the state's layout, as the hash is.
SHARES = 256
#: Rows of state a page has on the average before a share doubles its pages.
PAGE_ROWS = 1024
#: Items of lists that a package of results has at most, beside those of one row.
LIST_ITEMS = 1 << 20
HASH, SHARE = "pack_hash", "pack_share"


def _fields(df: DataFrame, names: list[str]) -> str:
    kinds = dict(df.dtypes)
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def _groups(table: pa.Table, keys: list[str], seq: str) -> tuple[pa.Table, np.ndarray]:
    """The rows sorted by key and `seq`, and where each key's begin. Null is a key."""
    codes = [pc.dictionary_encode(table.column(k).combine_chunks(), null_encoding="encode").indices.to_numpy() for k in keys]
    order = np.lexsort((table.column(seq).to_numpy(), *codes))
    new = np.ones(len(order), bool)
    if codes:
        new[1:] = np.any([np.diff(c[order]) != 0 for c in codes], axis=0)
    else:
        new[1:] = False
    return table.take(pa.array(order)), np.flatnonzero(new)


def packed(df: DataFrame, keys: list[str], seq: str, columns: list[str], pack_rows: int = PACK_ROWS) -> DataFrame:
    """keys, first, last, rows: the rows of each key that one task has read, in order, as a serialised Arrow batch."""
    rows = df.select(*keys, seq, *columns)
    inner = to_arrow_schema(rows.select(seq, *columns).schema)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= pack_rows:
                yield _pack(held)
                held = []
        if sum(b.num_rows for b in held):
            yield _pack(held)

    def _pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table, starts = _groups(pa.Table.from_batches(held), keys, seq)
        whole = table.select([seq, *columns]).cast(inner).combine_chunks().to_batches()[0]
        ends = np.r_[starts[1:], table.num_rows]
        order = table.column(seq).to_numpy()
        bodies = [whole.slice(a, b - a).serialize().to_pybytes() for a, b in zip(starts, ends)]
        first = table.take(pa.array(starts)).select(keys).combine_chunks()
        columns_out = [first.column(k).combine_chunks() for k in keys]
        columns_out += [pa.array(order[starts]), pa.array(order[ends - 1]), pa.array(bodies, pa.binary())]
        return pa.record_batch(columns_out, names=[*keys, "pack_first", "pack_last", "pack_rows"])

    lead = f"{_fields(rows, keys)}, " if keys else ""
    return rows.mapInArrow(pack, f"{lead}pack_first bigint, pack_last bigint, pack_rows binary")


def _written_out(part: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, int]]:
    """Rows with plain lists in place of views, in pieces of about LIST_ITEMS items, and the items of each piece."""
    views = [name for name, kind in zip(part.schema.names, part.schema.types) if pa.types.is_list_view(kind)]
    if not views:
        yield part, 0
        return
    sizes = {n: part.column(n).sizes.to_numpy() for n in views}
    cuts = np.flatnonzero(np.diff(np.cumsum(sum(sizes.values())) // LIST_ITEMS, prepend=0)).tolist()
    for a, b in zip([0, *cuts], [*cuts, part.num_rows]):
        columns, items = part.slice(a, b - a).columns, 0
        for name, size in sizes.items():
            view = part.column(name)
            starts = np.r_[0, np.cumsum(size[a:b])]
            at = np.arange(starts[-1]) + np.repeat(view.offsets.to_numpy()[a:b] - starts[:-1], size[a:b])
            plain = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), view.values.take(pa.array(at)))
            columns[part.schema.get_field_index(name)] = plain
            items += len(at)
        yield pa.record_batch(columns, names=part.schema.names), items


def unpack_batches(batches: Iterable[pa.RecordBatch], keys: list[str], inner: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of packed results in pieces of about PACK_ROWS, so that one batch of many large packages isn't held as rows.

    Where lists were sent as views a piece has about LIST_ITEMS items at most.
    """
    for batch in batches:
        held: list[tuple[int, pa.RecordBatch]] = []
        size = items = 0
        for at, body in enumerate(batch.column("pack_rows")):
            for part, more in _written_out(pa.ipc.read_record_batch(body.as_buffer(), inner)):
                if held and items + more > LIST_ITEMS:
                    yield _with_keys(batch, keys, held)
                    held, size, items = [], 0, 0
                if part.num_rows:
                    held.append((at, part))
                size, items = size + part.num_rows, items + more
                if size >= PACK_ROWS:
                    yield _with_keys(batch, keys, held)
                    held, size, items = [], 0, 0
        if held:
            yield _with_keys(batch, keys, held)


def _with_keys(batch: pa.RecordBatch, keys: list[str], held: list[tuple[int, pa.RecordBatch]]) -> pa.RecordBatch:
    """The rows of these packages, and the keys that each package of `batch` came with."""
    at, parts = zip(*held)
    again = pa.array(np.repeat(at, [p.num_rows for p in parts]))
    body = pa.Table.from_batches(parts).combine_chunks()
    values = [batch.column(k).take(again) for k in keys] + [c.combine_chunks() for c in body.columns]
    return pa.record_batch(values, names=[*keys, *body.column_names])


def unpacked(df: DataFrame, keys: list[str], ddl: str, inner: pa.Schema | None = None) -> DataFrame:
    """The rows of packed results, with their keys; `inner` is the schema of packages that aren't as the rows are."""
    inner = inner or to_arrow_schema(StructType.fromDDL(ddl))
    lead = f"{_fields(df, keys)}, " if keys else ""
    return df.select(*keys, "pack_rows").mapInArrow(lambda batches: unpack_batches(batches, keys, inner), f"{lead}{ddl}")


def _one(name: str, kind) -> StructType:
    """A one-field schema; built by hand, since processors start where no session is."""
    return StructType([StructField(name, kind)])


class KeyedStep(StatefulProcessor):
    """State of one key. Subclasses say what `step` does with rows in order and what `due` does when timers have come."""

    def __init__(self):
        self.keys, self.seq, self.inner, self.outer, self.many_keys = [], "", None, None, False

    def init(self, handle) -> None:
        self.handle = handle
        self.open()

    def open(self) -> None:
        """Make the state variables."""

    def step(self, rows: pa.Table, now: int) -> pa.Table | None:
        """Results of rows of the key in arrival order; `now` is the watermark or the time of the micro-batch."""
        raise NotImplementedError

    def pieces(self, rows: pa.Table, now: int) -> Iterator[pa.Table]:
        """The same in pieces, where results may be much larger than their rows."""
        out = self.step(rows, now)
        if out is not None:
            yield out

    def due(self, now: int) -> Iterator[pa.Table]:
        """Results of timers that have come, before any newer row is looked at."""
        return iter(())

    def package(self, rows: pa.Schema) -> pa.Schema:
        """The schema of a package of such results; lists may be views, which `unpack_batches` writes out."""
        return rows

    def for_many_keys(self) -> KeyedStep:
        """The step to run where keys are many: one of shared state, if there is one."""
        return self

    def close(self) -> None:
        pass

    def begin(self) -> None:
        """Before the rows of a key in a micro-batch."""

    def end(self) -> None:
        """After them: write what `step` has changed but not written."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame | Row]:
        now = self._now(timerValues)
        self.begin()
        for out in self.due(now):
            yield self._sent(key, out)
        for table in self._runs(sorted(self._packs(rows), key=lambda p: p[0])):
            for out in self.pieces(table, now):
                if out.num_rows:
                    yield self._sent(key, out)
        self.end()

    def _packs(self, rows: Iterator[pd.DataFrame | Row]) -> Iterator[tuple]:
        for some in rows:
            if isinstance(some, Row):
                yield some.pack_first, some.pack_last, some.pack_rows
            else:
                yield from zip(*(some[c].tolist() for c in ("pack_first", "pack_last", "pack_rows")))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.begin()
        for out in self.due(expiredTimerInfo.getExpiryTimeInMs()):
            yield self._sent(key, out)

    def _now(self, timerValues) -> int:
        return 0

    def _runs(self, packs: list[tuple]) -> Iterator[pa.Table]:
        """Stretches of rows in order; packages that overlap in `seq` are in one stretch."""
        held, last, size = [], None, 0
        for first, end, body in packs:
            if held and first > last and size >= PACK_ROWS:
                yield self._ordered(held)
                held, last, size = [], None, 0
            held.append(pa.ipc.read_record_batch(pa.py_buffer(body), self.inner))
            size += held[-1].num_rows
            last = end if last is None else max(last, end)
        if held:
            yield self._ordered(held)

    def _ordered(self, parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts).combine_chunks()
        order = table.column(self.seq).to_numpy()
        return table if (np.diff(order) > 0).all() else table.take(pa.array(np.argsort(order, kind="stable")))

    def _sent(self, key, out: pa.Table) -> pd.DataFrame | Row:
        body = out.select(self.outer.names).cast(self.outer).combine_chunks().to_batches()[0].serialize().to_pybytes()
        named = {**dict(zip(self.keys, key)), "pack_rows": body}
        return Row(**named) if self.many_keys else pd.DataFrame({k: [v] for k, v in named.items()})


class WatermarkStep(KeyedStep):
    def _now(self, timerValues) -> int:
        return timerValues.getCurrentWatermarkInMs()


class ClockStep(KeyedStep):
    def _now(self, timerValues) -> int:
        return timerValues.getCurrentProcessingTimeInMs()


def keyed_state(
    df: DataFrame,
    keys: list[str],
    seq: str,
    columns: list[str],
    step: KeyedStep,
    adds: str,
    keep: Callable[[str], bool] | None = None,
    pack_rows: int = PACK_ROWS,
    many_keys: bool = False,
) -> DataFrame:
    """Run `step` over the rows of each key of a stream; results have the keys, the kept columns and `adds` (a DDL).

    `step` gets a table of `seq` and `columns` and returns one with the kept ones of them and the columns of `adds`.
    Without keys the whole stream is one key. With `many_keys` a step whose state can be shared runs on shares of the
    keys. For others, and for shares whose entries stay for good, packages come and go as Spark rows, not as data frames:
    that costs less a key or share, but its results of a micro-batch are held together.
    """
    step = step.for_many_keys() if many_keys else step
    # Rows of a processor have their columns' names as attributes, so keys get plain ones on the way.
    names = {k: f"pack_key_{i}" for i, k in enumerate(keys)}
    df = df.withColumns({n: F.col(k) for k, n in names.items()} if keys else {"pack_key_all": F.lit(0)})
    keys = list(names.values()) or ["pack_key_all"]
    kept = [c for c in [seq, *columns] if keep is None or keep(c)]
    if isinstance(step, SharedStep):
        # Keys travel with their rows, and shares take their place.
        step.members, many_keys = keys, isinstance(step, LastingStep)
        df = df.withColumn(HASH, F.xxhash64(*keys)).withColumn(SHARE, F.pmod(HASH, F.lit(SHARES)))
        kept, columns, keys = [*keys, *kept], [HASH, *keys, *columns], [SHARE]
    ddl = ", ".join(x for x in (_fields(df, kept), adds) if x)
    step.keys, step.seq = keys, seq
    step.inner = to_arrow_schema(df.select(seq, *columns).schema)
    step.outer = step.package(to_arrow_schema(StructType.fromDDL(ddl)))
    mode = "EventTime" if isinstance(step, WatermarkStep) else "ProcessingTime" if isinstance(step, ClockStep) else "None"
    step.many_keys = many_keys
    groups = packed(df, keys, seq, columns, pack_rows).groupBy(*keys)
    out = (groups.transformWithState if many_keys else groups.transformWithStateInPandas)(
        statefulProcessor=step,
        outputStructType=StructType.fromDDL(f"{_fields(df, keys)}, pack_rows binary"),
        outputMode="Append",
        timeMode=mode,
    )
    return unpacked(out, keys, ddl, step.outer).withColumnsRenamed({n: k for k, n in names.items()}).drop("pack_key_all", SHARE)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """A whole-number column; null adds nothing."""
    return pc.fill_null(column, 0).combine_chunks().to_numpy(zero_copy_only=False)


def _with(rows: pa.Table, **columns) -> pa.Table:
    for name, values in columns.items():
        rows = rows.append_column(name, values if isinstance(values, (pa.Array, pa.ChunkedArray)) else pa.array(values))
    return rows


class RunningSum(KeyedStep):
    """A value state: the sum after every row."""

    def __init__(self, value: str, name: str = "running"):
        super().__init__()
        self.value, self.name = value, name

    def open(self) -> None:
        self.total = self.handle.getValueState("total", _one("total", LongType()))

    def step(self, rows, now):
        held = self.total.get()
        sums = np.cumsum(_numbers(rows.column(self.value))) + (held[0] if held else 0)
        self.total.update((int(sums[-1]),))
        return _with(rows, **{self.name: sums})


class ChangeLog(RunningSum):
    """The sum as a change log: the old total is taken back (except before the first row), the new one added."""

    def step(self, rows, now):
        known = self.total.exists()
        rows = super().step(rows, now)
        after, values = rows.column(self.name).to_numpy(), _numbers(rows.column(self.value))
        twice = rows.take(pa.array(np.repeat(np.arange(len(after)), 2))).drop_columns([self.name])
        totals, added = np.stack([after - values, after], axis=1).reshape(-1), np.tile([False, True], len(after))
        out = _with(twice, **{self.name: totals, "added": added})
        return out if known else out.slice(1)


class MapSums(KeyedStep):
    """A map state of one sum a sub-key beside the sum of all: both after every row."""

    def __init__(self, sub_key: str, value: str, part: str = "part", total: str = "total"):
        super().__init__()
        self.sub_key, self.value, self.part, self.total = sub_key, value, part, total

    def open(self) -> None:
        self.sums = Pages(self.handle, "sums", (0,))
        self.all = self.handle.getValueState("all", _one("v", LongType()))

    def begin(self):
        self.sums.begin()

    def end(self):
        self.sums.write()

    def step(self, rows, now):
        values, codes, names = _numbers(rows.column(self.value)), *_coded(rows.column(self.sub_key))
        at, total = self.sums.places(names), self.all.get()
        parts = _cumsum_by(codes, values) + self.sums.values[0][at][codes]
        np.add.at(self.sums.values[0], at[codes], values)
        totals = np.cumsum(values) + (total[0] if total else 0)
        self.all.update((int(totals[-1]),))
        return _with(rows, **{self.part: parts, self.total: totals})


def _coded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    coded = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    return coded.indices.to_numpy(), coded.dictionary


class Pages:
    """A map state of whole numbers a sub-key. Sub-keys are dealt to pages by their hash, and a page is one state entry.

    A micro-batch reads the pages of the sub-keys it meets and writes them once, in place of three calls a sub-key and
    stretch of rows. `values` has a row of numbers for each of `fresh`, which is what a new sub-key starts with.
    """

    PAGES = 512

    def __init__(self, handle, name: str, fresh: tuple):
        fields = [StructField("page", LongType())], [StructField("body", BinaryType())]
        self.state, self.fresh = handle.getMapState(name, *(StructType(f) for f in fields)), np.array(fresh, np.int64)
        self.schema = pa.schema([("name", pa.string()), *((f"v{i}", pa.int64()) for i in range(len(fresh)))])
        self.begin()

    def begin(self) -> None:
        self.read: set[int] = set()
        self.names, self.pages = pa.array([], pa.string()), np.empty(0, np.int64)
        self.values = np.empty((len(self.fresh), 0), np.int64)

    def _page(self, names: pa.Array) -> np.ndarray:
        return (pd.util.hash_array(names.to_numpy(zero_copy_only=False), categorize=False) % self.PAGES).astype(np.int64)

    def _add(self, names: list[pa.Array], values: list[np.ndarray]) -> None:
        self.pages = np.r_[self.pages, *(self._page(n) for n in names)]
        self.names = pa.concat_arrays([self.names, *names])
        self.values = np.concatenate([self.values, *values], axis=1)

    def _numbers(self, body: bytes) -> tuple[pa.Array, np.ndarray]:
        rows = pa.ipc.read_record_batch(pa.py_buffer(bytes(body)), self.schema)
        return rows.column(0), np.stack([c.to_numpy() for c in rows.columns[1:]])

    def _body(self, names: pa.Array, values: np.ndarray) -> bytes:
        return pa.record_batch([names, *(pa.array(v) for v in values)], schema=self.schema).serialize().to_pybytes()

    def places(self, names: pa.Array) -> np.ndarray:
        """Where in `values` each of these different names stands."""
        unread = [int(p) for p in np.unique(self._page(names)) if p not in self.read]
        self.read.update(unread)
        known = [self._numbers(got[0]) for got in (self.state.getValue((p,)) for p in unread) if got]
        if known:
            self._add(*map(list, zip(*known)))
        at = pc.fill_null(pc.index_in(names, self.names), -1).to_numpy().astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self.values.shape[1] + np.arange(len(new))
            self._add([names.take(pa.array(new))], [np.repeat(self.fresh[:, None], len(new), axis=1)])
        return at

    def write(self) -> None:
        order = np.argsort(self.pages, kind="stable")
        names, values, pages = self.names.take(pa.array(order)), self.values[:, order], self.pages[order]
        cuts = np.flatnonzero(np.r_[True, np.diff(pages) != 0]) if len(pages) else []
        for a, b in zip(cuts, [*cuts[1:], len(pages)]):
            self.state.updateValue((int(pages[a]),), (self._body(names.slice(a, b - a), values[:, a:b]),))
        self.begin()

    def keep(self, which: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """Remove the sub-keys that `which`, a mask over their numbers, leaves out; the numbers of the rest."""
        kept = [np.empty((len(self.fresh), 0), np.int64)]
        for (page,), (body,) in list(self.state.iterator()):
            names, values = self._numbers(body)
            mask = which(values)
            if not mask.any():
                self.state.removeKey((page,))
            elif not mask.all():
                self.state.updateValue((page,), (self._body(names.filter(pa.array(mask)), values[:, mask]),))
            kept.append(values[:, mask])
        return np.concatenate(kept, axis=1)


class OneEntry:
    """The same for a key without sub-keys: a value state."""

    def __init__(self, handle, name: str, fresh: tuple):
        fields = StructType([StructField(f"v{i}", LongType()) for i in range(len(fresh))])
        self.state, self.fresh = handle.getValueState(name, fields), np.array(fresh, np.int64)
        self.begin()

    def begin(self) -> None:
        self.values = None

    def places(self, names: pa.Array) -> np.ndarray:
        if self.values is None:
            self.values = np.array(self.state.get() or self.fresh, np.int64)[:, None]
        return np.zeros(1, np.int64)

    def write(self) -> None:
        if self.values is not None:
            self.state.update(tuple(int(v) for v in self.values[:, 0]))
        self.begin()

    def keep(self, which: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        held = self.state.get()
        values = np.empty((len(self.fresh), 0), np.int64) if held is None else np.array(held, np.int64)[:, None]
        if held is not None and not which(values).all():
            self.state.clear()
        return values[:, which(values)]


def _cumsum_by(codes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Running sums within each code, in the order given."""
    order = np.argsort(codes, kind="stable")
    sums = np.cumsum(values[order])
    first = np.flatnonzero(np.r_[True, np.diff(codes[order]) != 0])
    before = np.r_[0, sums][first]
    out = np.empty_like(sums)
    out[order] = sums - np.repeat(before, np.diff(np.r_[first, len(codes)]))
    return out


class GrowingList(KeyedStep):
    """A list state of `item`: the whole list after every row, which grows with the square of a key's rows."""

    def __init__(self, item: str, name: str = "items"):
        super().__init__()
        self.item, self.name = item, name

    def for_many_keys(self):
        return SharedLists(self.item, self.name)

    def open(self) -> None:
        self.items = self.handle.getListState("items", _one("some", BinaryType()))

    def step(self, rows, now):
        kind = pa.schema([("item", pa.string())])
        new = rows.column(self.item).combine_chunks()
        known = pc.is_valid(new).to_numpy(zero_copy_only=False)
        held = [pa.ipc.read_record_batch(pa.py_buffer(bytes(v[0])), kind).column(0) for v in self.items.get()] if self.items.exists() else []
        every = pa.concat_arrays([*held, new.drop_null()])
        if known.any():
            self.items.appendValue((pa.record_batch([every[-known.sum():]], schema=kind).serialize().to_pybytes(),))
        ends = len(every) - known.sum() + np.cumsum(known)
        first = np.r_[0, np.cumsum(ends)]
        lists = every.take(pa.array(np.arange(first[-1]) - np.repeat(first[:-1], ends)))
        return _with(rows, **{self.name: pa.ListArray.from_arrays(pa.array(first, pa.int32()), lists)})


class CountWindows(KeyedStep):
    """Every `size` rows of the key fire once, with their sum; an unfinished rest stays in state and is never sent."""

    def __init__(self, value: str, size: int, name: str = "total"):
        super().__init__()
        self.value, self.size, self.name = value, size, name

    def open(self) -> None:
        fields = StructType([StructField(n, LongType()) for n in ("fired", "rows", "total")])
        self.open_window = self.handle.getValueState("open", fields)

    def step(self, rows, now):
        fired, count, total = self.open_window.get() or (0, 0, 0)
        sums = np.r_[0, np.cumsum(_numbers(rows.column(self.value)))] + total
        ends = np.arange(self.size - count, rows.num_rows + 1, self.size)
        last = int(ends[-1]) if len(ends) else 0
        rest = count + rows.num_rows - len(ends) * self.size
        totals = np.diff(np.r_[0, sums[ends]]) if len(ends) else sums[:0]
        self.open_window.update((fired + len(ends), rest, int(sums[-1] - (sums[last] if len(ends) else 0))))
        return pa.table({"win_no": pa.array(fired + np.arange(len(ends))), self.name: pa.array(totals)})


class LatestValue(KeyedStep):
    """State shared by two kinds of rows: those where `is_rule` set what the others see, null if nothing was set.

    A rule whose value is null takes the earlier one back.
    """

    def __init__(self, is_rule: str, value: str, name: str, kind=StringType()):
        super().__init__()
        self.is_rule, self.value, self.name, self.kind = is_rule, value, name, kind

    def for_many_keys(self):
        return SharedLatest(self.is_rule, self.value, self.name)

    def open(self) -> None:
        self.now = self.handle.getValueState("now", _one("v", self.kind))

    def step(self, rows, now):
        rule = pc.fill_null(rows.column(self.is_rule), False).combine_chunks().to_numpy(zero_copy_only=False)
        held = (self.now.get() or (None,))[0]
        values = rows.column(self.value).combine_chunks()
        known = pa.concat_arrays([pa.array([held], values.type), values])
        seen = known.take(pa.array(np.maximum.accumulate(np.where(rule, np.arange(1, len(rule) + 1), 0))))
        if rule.any():
            last = seen[-1].as_py()
            if last is None:
                if held is not None:
                    self.now.clear()
            elif last != held:
                self.now.update((last,))
        facts = pa.array(np.flatnonzero(~rule))
        return _with(rows.take(facts), **{self.name: seen.take(facts)})


class HeldRows(KeyedStep):
    """Rows held back until the timer of their key at the next full `every_ms` of the clock, with its time.

    A row sets the timer after the clock it sees; timers of one instant are one. Rows that come when a timer is due are
    newer than what it sends.
    """

    def __init__(self, every_ms: int = 60_000, arrived: str | None = None):
        super().__init__()
        self.every_ms, self.arrived = every_ms, arrived

    def open(self) -> None:
        fields = StructType([StructField("rows", BinaryType()), StructField("at", LongType()), StructField("seen", LongType())])
        self.buffer = self.handle.getListState("buffer", fields)

    def step(self, rows, now):
        at = now - now % self.every_ms + self.every_ms
        body = rows.select(self.inner.names).combine_chunks().to_batches()[0].serialize().to_pybytes()
        self.buffer.appendValue((body, at, now))
        self.handle.registerTimer(at)
        return None

    def due(self, now):
        if not self.buffer.exists():
            return
        rest, sent = [], False
        for body, at, seen in self.buffer.get():
            if at > now:
                rest.append((body, at, seen))
                continue
            sent = True
            rows = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(bytes(body)), self.inner)])
            extra = {"flushed_at": np.full(rows.num_rows, at)}
            if self.arrived:
                extra[self.arrived] = np.full(rows.num_rows, seen)
            yield _with(rows, **extra)
        if sent:
            self.buffer.clear()
        if sent and rest:
            self.buffer.put(rest)


class HeldRowsByWatermark(HeldRows, WatermarkStep):
    pass


class HeldRowsByClock(HeldRows, ClockStep):
    pass


class ExpiringSums(WatermarkStep):
    """A map state of one sum a sub-key that is forgotten `ttl_ms` after its last write, in recorded time.

    A row that comes `ttl_ms` or more after its entry was written starts anew. The state itself shrinks by timers: one
    stands at the earliest expiry of the key's entries, and removes those whose time has come by the watermark.
    """

    NEVER = np.iinfo(np.int64).min // 2

    def __init__(self, sub_key: str | None, value: str, at_ms: str, ttl_ms: int, name: str = "live_sum"):
        super().__init__()
        self.sub_key, self.value, self.at_ms, self.ttl_ms, self.name = sub_key, value, at_ms, ttl_ms, name

    def for_many_keys(self):
        return self if self.sub_key else SharedSums(self.value, self.at_ms, self.ttl_ms, self.name)

    def open(self) -> None:
        self.sums = (Pages if self.sub_key else OneEntry)(self.handle, "sums", (0, self.NEVER))
        self.next = self.handle.getValueState("next", _one("at", LongType()))

    def begin(self):
        self.sums.begin()
        self.stands = self.next.get()

    def end(self):
        self.sums.write()

    def step(self, rows, now):
        values, at = _numbers(rows.column(self.value)), rows.column(self.at_ms).to_numpy()
        codes, names = _coded(rows.column(self.sub_key)) if self.sub_key else (np.zeros(len(at), np.int64), None)
        places = self.sums.places(names)
        totals, last = self.sums.values[:, places]
        order = np.argsort(codes, kind="stable")
        code, value, time = codes[order], values[order], at[order]
        opens = np.r_[True, np.diff(code) != 0]
        before = np.where(opens, last[code], np.r_[self.NEVER, time[:-1]])
        anew = (before == self.NEVER) | (time - before >= self.ttl_ms)
        # Sums since the last start; a run that goes on from the state takes its total along.
        carried = np.where(opens & ~anew, totals[code], 0)
        sums = np.cumsum(value + carried)
        start = np.maximum.accumulate(np.where(opens | anew, np.arange(len(sums)), 0))
        live = sums - np.r_[0, sums][start]
        ends = np.r_[np.flatnonzero(opens)[1:], len(code)] - 1
        self.sums.values[:, places[code[ends]]] = live[ends], time[ends]
        self._stand_at(int(time[ends].min()) + self.ttl_ms)
        out = np.empty_like(live)
        out[order] = live
        return _with(rows, **{self.name: out})

    def _stand_at(self, at: int) -> None:
        if self.stands:
            if self.stands[0] <= at:
                return
            self.handle.deleteTimer(self.stands[0])
        self._set(at)

    def _set(self, at: int) -> None:
        self.handle.registerTimer(at)
        self.stands = (at,)
        self.next.update(self.stands)

    def due(self, now):
        if not self.stands or self.stands[0] > now:
            return iter(())
        at, self.stands = self.stands[0], None
        rest = self.sums.keep(lambda values: values[1] + self.ttl_ms > now)
        if rest.shape[1]:
            self._set(int(rest[1].min()) + self.ttl_ms)
        else:
            self.next.clear()
            self.handle.deleteTimer(at)
        return iter(())


#: A time that is not known: it comes from no row, or is null.
NEVER = ExpiringSums.NEVER


def _times(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column, NEVER).combine_chunks().to_numpy(zero_copy_only=False)


class SharedEntries:
    """What is held of the keys of a share: rows of state, each forgotten `ttl_ms` after its own time `at`.

    Keys are dealt to pages by their hash, and a page is one state entry. A micro-batch reads the pages of the keys it
    meets and writes them once. A page's rows stay few: where they come to be more, there are twice as many pages. One
    timer stands at the earliest expiry of the share, or before it.
    """

    def __init__(self, handle, schema: pa.Schema, ttl_ms: int):
        self.handle, self.schema, self.ttl_ms = handle, schema, ttl_ms
        self.state = handle.getMapState("pages", _one("page", LongType()), _one("body", BinaryType()))
        self.about = handle.getValueState("about", StructType([StructField(n, LongType()) for n in ("pages", "rows", "timer")]))

    def begin(self) -> None:
        known = self.about.get()
        self.known = known and tuple(known)
        self.pages, self.rows, self.timer = self.known or (1, 0, None)
        self.read: dict[int, int] = {}
        self.changed: set[int] = set()
        self.held = self.schema.empty_table()

    def _page(self, table: pa.Table) -> np.ndarray:
        return table.column(HASH).to_numpy() // SHARES % self.pages

    def _load(self, pages: Iterable[int]) -> None:
        unread = [p for p in pages if p not in self.read]
        found = [self.state.getValue((p,)) if self.rows else None for p in unread]
        parts = [pa.ipc.read_record_batch(pa.py_buffer(bytes(got[0])), self.schema) if got else None for got in found]
        self.read.update((p, 0 if part is None else part.num_rows) for p, part in zip(unread, parts))
        parts = [part for part in parts if part is not None]
        if parts:
            self.held = pa.concat_tables([self.held, pa.Table.from_batches(parts)])

    def of(self, rows: pa.Table) -> pa.Table:
        """The entries of all pages that were met, with those of the keys of `rows`; `put` takes what becomes of them."""
        pages = np.unique(self._page(rows)).tolist()
        self._load(pages)
        self.changed.update(pages)
        return self.held

    def put(self, entries: pa.Table) -> None:
        self.held = entries

    def _until(self) -> np.ndarray:
        at = _times(self.held.column("at"))
        return np.where(at == NEVER, np.iinfo(np.int64).max, at + self.ttl_ms)

    def forget(self, now: int) -> None:
        """Remove the entries whose time has come."""
        if self.timer is None or self.timer > now:
            return
        self._load(range(self.pages))
        gone = self._until() <= now
        self.changed.update(np.unique(self._page(self.held)[gone]).tolist())
        self.held = self.held.filter(pa.array(~gone))
        self.handle.deleteTimer(self.timer)
        self.timer = None

    def write(self) -> None:
        self.rows += self.held.num_rows - sum(self.read.values())
        if self.rows > self.pages * PAGE_ROWS:
            self._load(range(self.pages))
            while self.rows > self.pages * PAGE_ROWS:
                self.pages *= 2
            self.changed.update(range(self.pages))
        pages = self._page(self.held)
        order = np.argsort(pages, kind="stable")
        sorted_rows = self.held.take(pa.array(order)).combine_chunks()
        cuts = np.searchsorted(pages[order], np.arange(self.pages + 1)).tolist()
        for page in sorted(self.changed):
            first, end = cuts[page], cuts[page + 1]
            if first < end:
                body = sorted_rows.slice(first, end - first).combine_chunks().to_batches()[0]
                self.state.updateValue((page,), (body.serialize().to_pybytes(),))
            elif self.read.get(page):
                self.state.removeKey((page,))
        self._stand_at(int(self._until().min(initial=np.iinfo(np.int64).max)))
        about = (self.pages, self.rows, self.timer) if self.rows else None
        if about is None and self.known:
            self.about.clear()
        elif about != self.known:
            self.about.update(about)

    def _stand_at(self, at: int) -> None:
        if at == np.iinfo(np.int64).max or self.timer is not None and self.timer <= at:
            return
        if self.timer is not None:
            self.handle.deleteTimer(self.timer)
        self.handle.registerTimer(at)
        self.timer = at


class SharedStep(KeyedStep):
    """State of the keys of a share, `members` by name, in entries of one schema.

    A key is told from others by `codes`; the rows of all keys of a share are worked on together.
    """

    def __init__(self, name: str):
        super().__init__()
        self.name, self.members = name, []

    def entry(self) -> list[pa.Field]:
        """What an entry holds beside its key."""
        raise NotImplementedError

    def schema(self) -> pa.Schema:
        return pa.schema([*(self.inner.field(n) for n in (HASH, *self.members)), *self.entry()])

    def begin(self):
        self.entries.begin()

    def end(self):
        self.entries.write()

    def keys_of(self, held: pa.Table, rows: pa.Table) -> pa.Table:
        names = [HASH, *self.members]
        return pa.concat_tables([held.select(names), rows.select(names)])

    def codes(self, keys: pa.Table) -> np.ndarray:
        """A number for each different key. Null is a key."""
        out = np.zeros(keys.num_rows, np.int64)
        for name in self.members:
            code = _coded(keys.column(name))[0].astype(np.int64)
            out = np.unique(out * (code.max(initial=0) + 1) + code, return_inverse=True)[1]
        return out


class ExpiringStep(SharedStep, WatermarkStep):
    """The same where each entry expires in recorded time."""

    def __init__(self, at_ms: str, ttl_ms: int, name: str):
        super().__init__(name)
        self.at_ms, self.ttl_ms = at_ms, ttl_ms

    def open(self) -> None:
        self.entries = SharedEntries(self.handle, self.schema().append(pa.field("at", pa.int64())), self.ttl_ms)

    def due(self, now):
        self.entries.forget(now)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All entries of the share go whose time has come by the watermark, not only those of this timer."""
        self.begin()
        self.entries.forget(self._now(timerValues))
        self.end()
        return iter(())


class LastingEntries:
    """What is held for good of the keys of a share: rows of state, of which a step takes one page at a time.

    Keys are dealt to pages by their hash, and a page is one state entry. Where rows come to be more than PAGE_ROWS a
    page, there are twice as many pages, and each is split by itself. So a task holds a page, not the state of a share.
    """

    def __init__(self, handle, schema: pa.Schema):
        self.schema = schema
        self.state = handle.getMapState("pages", _one("page", LongType()), _one("body", BinaryType()))
        self.about = handle.getValueState("about", StructType([StructField(n, LongType()) for n in ("pages", "rows")]))

    def begin(self) -> None:
        self.known = tuple(self.about.get() or (1, 0))
        self.pages, self.rows = self.known

    def page_of(self, table: pa.Table) -> np.ndarray:
        return table.column(HASH).to_numpy() // SHARES % self.pages

    def of(self, page: int) -> pa.Table:
        got = self.state.getValue((page,)) if self.rows else None
        parts = [pa.ipc.read_record_batch(pa.py_buffer(bytes(got[0])), self.schema)] if got else []
        return pa.Table.from_batches(parts, self.schema)

    def put(self, page: int, held: pa.Table, entries: pa.Table) -> None:
        """Write `entries` in place of what the page has held."""
        self.rows += entries.num_rows - held.num_rows
        if entries.num_rows:
            body = entries.select(self.schema.names).combine_chunks().to_batches()[0]
            self.state.updateValue((page,), (body.serialize().to_pybytes(),))
        elif held.num_rows:
            self.state.removeKey((page,))

    def _double(self) -> None:
        half, self.pages = self.pages, 2 * self.pages
        for page in range(half):
            held = self.of(page)
            moves = self.page_of(held) != page
            if moves.any():
                self.put(page + half, held.slice(0, 0), held.filter(pa.array(moves)))
                self.put(page, held, held.filter(pa.array(~moves)))

    def write(self) -> None:
        while self.rows > self.pages * PAGE_ROWS:
            self._double()
        if (self.pages, self.rows) != self.known:
            self.about.update((self.pages, self.rows))


class LastingStep(SharedStep):
    """The same where entries stay for good; subclasses say what `of_page` does with a page and the new rows of its keys."""

    def open(self) -> None:
        self.entries = LastingEntries(self.handle, self.schema())

    def of_page(self, page: int, held: pa.Table, rows: pa.Table) -> Iterator[pa.Table]:
        raise NotImplementedError

    def pieces(self, rows, now):
        pages = self.entries.page_of(rows)
        order = np.argsort(pages, kind="stable")
        rows, pages = rows.take(pa.array(order)), pages[order]
        opens, ends = _runs_of(pages)
        for a, b in zip(np.flatnonzero(opens).tolist(), ends.tolist()):
            page = int(pages[a])
            yield from self.of_page(page, self.entries.of(page), rows.slice(a, b - a))


def _runs_of(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of sorted codes are the first of theirs, and where each one's end."""
    opens = np.diff(code, prepend=-1) != 0
    return opens, np.r_[np.flatnonzero(opens)[1:], len(code)]


class SharedSums(ExpiringStep):
    """`ExpiringSums` without sub-keys, for many keys: a sum and the time of its last write each.

    Rows of state come in front of the new rows of their key, as if they were its first. A row without a time neither
    restarts a sum nor lets the next one do so.
    """

    def __init__(self, value: str, at_ms: str, ttl_ms: int, name: str):
        super().__init__(at_ms, ttl_ms, name)
        self.value = value

    def entry(self):
        return [pa.field("total", pa.int64())]

    def step(self, rows, now):
        held = self.entries.of(rows)
        keys = self.keys_of(held, rows)
        code = self.codes(keys)
        order = np.argsort(code, kind="stable")
        value = np.r_[held.column("total").to_numpy(), _numbers(rows.column(self.value))][order]
        time = np.r_[_times(held.column("at")), _times(rows.column(self.at_ms))][order]
        opens, ends = _runs_of(code[order])
        before = np.r_[NEVER, time[:-1]]
        anew = opens | ((time != NEVER) & (before != NEVER) & (time - before >= self.ttl_ms))
        sums = np.cumsum(value)
        live = sums - np.r_[0, sums][np.maximum.accumulate(np.where(anew, np.arange(len(sums)), 0))]
        last = time[ends - 1]
        lasting = {"total": live[ends - 1], "at": pa.array(last, mask=last == NEVER)}
        self.entries.put(_with(keys.take(pa.array(order[ends - 1])), **lasting))
        out = np.empty_like(live)
        out[order] = live
        return _with(rows, **{self.name: out[held.num_rows :]})


def _first_from(time: np.ndarray, until: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each place the first one after it whose time is `until` or later, or `ends` if there is none before that.

    Times need not be in order, so the largest of 1, 2, 4, ... places from each on tell how far one may skip.
    """
    largest, longest = [time], int((ends - np.arange(len(time))).max(initial=0))
    while 1 << len(largest) < longest:
        half, top = 1 << (len(largest) - 1), largest[-1].copy()
        top[:-half] = np.maximum(top[:-half], largest[-1][half:])
        largest.append(top)
    at = np.arange(1, len(time) + 1)
    for k in reversed(range(len(largest))):
        skips = at + (1 << k) <= ends
        skips[skips] = largest[k][at[skips]] < until[skips]
        at[skips] += 1 << k
    return at


class ExpiringList(ExpiringStep):
    """A list state whose items each live `ttl_ms` of recorded time: the live list after every row, by arrival.

    A row that finds an item expired removes it for good, whatever times come later. A row without a time has no list
    and is in none.
    """

    def __init__(self, item: str, at_ms: str, ttl_ms: int, name: str = "items"):
        super().__init__(at_ms, ttl_ms, name)
        self.item = item

    def entry(self):
        return [pa.field("item", pa.string())]

    def pieces(self, rows, now):
        rows = rows.filter(pc.is_valid(rows.column(self.at_ms)))
        if not rows.num_rows:
            return
        held = self.entries.of(rows)
        keys = self.keys_of(held, rows)
        code = self.codes(keys)
        order = np.argsort(code, kind="stable")
        time = np.r_[_times(held.column("at")), _times(rows.column(self.at_ms))][order]
        items = pa.chunked_array([*held.column("item").chunks, *rows.column(self.item).chunks], pa.string()).combine_chunks()
        items = items.take(pa.array(order))
        opens, ends = _runs_of(code[order])
        sizes = np.diff(np.r_[0, ends])
        end = np.repeat(ends, sizes)
        gone = _first_from(time, time + self.ttl_ms, end)
        lasting = np.flatnonzero(gone == end)
        entries = keys.take(pa.array(order[lasting]))
        self.entries.put(_with(entries, item=items.take(pa.array(lasting)), at=time[lasting]))
        # Items are in the lists of new rows from their own on; rows of state come before the new ones of their key.
        new = order >= held.num_rows
        first_new = np.repeat(np.add.reduceat((~new).astype(np.int64), np.flatnonzero(opens)) + np.r_[0, ends[:-1]], sizes)
        begin = np.maximum(np.arange(len(code)), first_new)
        shown = pc.is_valid(items).to_numpy(zero_copy_only=False) & (begin < gone)
        yield from self._lists(rows, order - held.num_rows, new, items, begin, gone, shown)

    def _lists(self, rows, place, new, items, begin, gone, shown) -> Iterator[pa.Table]:
        change = np.zeros(len(new) + 1, np.int64)
        np.add.at(change, begin[shown], 1)
        np.add.at(change, gone[shown], -1)
        size = np.cumsum(change)[:-1]
        cuts = np.flatnonzero(np.diff(np.cumsum(size) // LIST_ITEMS, prepend=0)).tolist()
        for a, b in zip([0, *cuts], [*cuts, len(new)]):
            here = np.flatnonzero(shown & (begin < b) & (gone > a))
            low, high = np.maximum(begin[here], a), np.minimum(gone[here], b)
            count = high - low
            at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
            taken = np.repeat(here, count)[np.argsort(at, kind="stable")]
            mine = new[a:b]
            starts = np.r_[0, np.cumsum(size[a:b][mine])]
            lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), items.take(pa.array(taken)))
            yield _with(rows.take(pa.array(place[a:b][mine])), **{self.name: lists})


class SharedLists(LastingStep):
    """`GrowingList` for many keys: an item is a row of state, those of a key in the order of arrival.

    A package has a page's items once, and each row's list as a view of them, so it grows with rows, not their square.
    """

    def __init__(self, item: str, name: str):
        super().__init__(name)
        self.item = item

    def entry(self):
        return [pa.field("item", pa.string())]

    def package(self, rows):
        at = rows.get_field_index(self.name)
        return rows.set(at, pa.field(self.name, pa.list_view(pa.string())))

    def of_page(self, page, held, rows):
        keys = self.keys_of(held, rows)
        code = self.codes(keys)
        order = np.argsort(code, kind="stable")
        items = pa.chunked_array([*held.column("item").chunks, *rows.column(self.item).chunks], pa.string()).combine_chunks()
        known = pc.is_valid(items).to_numpy(zero_copy_only=False)[order]
        lasting = pa.array(order[known])
        items = items.take(lasting)
        self.entries.put(page, held, _with(keys.take(lasting), item=items))
        # A row's list goes from the first item of its key to the last one up to the row itself.
        opens, ends = _runs_of(code[order])
        until = np.cumsum(known)
        first = np.repeat((until - known)[opens], np.diff(np.r_[0, ends]))
        new = order >= held.num_rows
        first, size = (pa.array(x[new], pa.int32()) for x in (first, until - first))
        lists = pa.ListViewArray.from_arrays(first, size, items)
        yield _with(rows.take(pa.array(order[new] - held.num_rows)), **{self.name: lists})


class SharedLatest(LastingStep):
    """`LatestValue` for many keys: a row of state is the last rule of its key, in front of the key's new rows."""

    def __init__(self, is_rule: str, value: str, name: str):
        super().__init__(name)
        self.is_rule, self.value = is_rule, value

    def entry(self):
        return [pa.field("value", self.inner.field(self.value).type)]

    def of_page(self, page, held, rows):
        keys = self.keys_of(held, rows)
        code = self.codes(keys)
        order = np.argsort(code, kind="stable")
        is_rule = pc.fill_null(rows.column(self.is_rule), False).combine_chunks().to_numpy(zero_copy_only=False)
        rule = np.r_[np.ones(held.num_rows, bool), is_rule][order]
        values = pa.chunked_array([*held.column("value").chunks, *rows.column(self.value).chunks], self.entry()[0].type)
        opens, ends = _runs_of(code[order])
        # The last rule up to each row; where that is none, the first row of the key stands for it, which has no value.
        at = np.maximum.accumulate(np.where(rule | opens, np.arange(len(order)), 0))
        seen = values.combine_chunks().take(pa.array(order[at], mask=~rule[at]))
        if is_rule.any():
            last = seen.take(pa.array(ends - 1))
            lasting = keys.take(pa.array(order[ends - 1])).filter(last.is_valid())
            self.entries.put(page, held, _with(lasting, value=last.drop_null()))
        facts = (order >= held.num_rows) & ~rule
        yield _with(rows.take(pa.array(order[facts] - held.num_rows)), **{self.name: seen.filter(pa.array(facts))})
