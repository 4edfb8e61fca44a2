"""Substring dedup with a count-min prefilter.

A window is `window` consecutive words of one text. A word covered by a window whose word sequence also starts
anywhere else goes. Pass 1 counts one sampled gram per neighbourhood of windows in count-min sketches, one per task,
merged block by block. Pass 2 groups exactly only the windows whose gram the merged sketch estimates as repeated: by that
gram, or by the whole window where very many rows share the gram. The
sketch overestimates, so no repeated window is lost; a full sketch only lets more windows through to pass 2.

Sampling: the `GRAM`-word gram with the smallest hash in every window is its anchor. Equal windows have equal anchors
at equal places, so a repeated window has an anchor that occurs at two places.

Defined results: a null text and a text without words have no words, nothing is removed. Repeated rows and equal texts
are each other's copies: all their words go if a text has at least `window` words. A text shorter than a window keeps
all. Ties do not exist: every occurrence goes, the first one too. Empty tables give empty results. Columns beside
doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import text_key
from tidemill.llm.text import NOT_SPACE, U64, Words, complete, grams, mix, pieces, sliding_min

WINDOW = 35
#: Words of a gram; a window holds WINDOW - GRAM + 1 of them.
GRAM = 20
#: Cells of one of the two sketch rows, as a power of two. The merged sketch is broadcast as one bit a cell
#: (is the count over one?): 2 * 2**27 / 8 bytes = 32 MiB at most, whatever the input.
CELL_BITS = 27
BLOCK_BITS = 20
ROWS = 2
#: Distinct anchors a task gathers before it sends its partial sketch.
ANCHORS_HELD = 4_000_000
#: An anchor with so many rows of candidates is hot: its windows are dealt out by their own hashes. A task doesn't report
#: an anchor with fewer than `REPORTED` rows, so a group holds fewer than HOT_ROWS rows and REPORTED a task. This
#: changes no result. The list of hot anchors has an entry for HOT_ROWS rows at most.
HOT_ROWS, REPORTED = 2_000, 4
_ROW_SEEDS = (0x0, 0x9E3779B97F4A7C15)


def _cells(anchors: np.ndarray, row: int, cell_bits: int) -> np.ndarray:
    return (mix(anchors + U64(_ROW_SEEDS[row])) >> U64(64 - cell_bits)).astype(np.int64)


class _Windows:
    """Window starts of a piece of texts, their anchors, and the anchors' places."""

    def __init__(self, column: pa.Array, window: int):
        gram = min(GRAM, window)
        self.words = Words(column, NOT_SPACE)
        self.hashes = self.words.hashes()
        self.valid = complete(self.words, window)
        places = grams(self.hashes, gram) | U64(1)  # zero stands for no window below
        self.span = window - gram + 1
        self.anchor = sliding_min(places, self.span)[: len(self.valid)]
        self.places = places

    def selected(self) -> np.ndarray:
        """Anchors at each place that is the minimum of some window."""
        if not self.valid.any():
            return np.zeros(0, U64)
        lowest = np.where(self.valid, self.anchor, U64(0))  # no window: below all
        reach = np.zeros(len(self.places) + self.span - 1, U64)
        reach[self.span - 1 : self.span - 1 + len(lowest)] = lowest
        # The largest minimum among the windows that hold a place equals its value if it is one of their minima.
        top = ~sliding_min(~reach, self.span)
        return self.places[: len(top)][(top == self.places[: len(top)]) & (top != 0)]


def _partial_sketches(window: int, cell_bits: int):
    schema = pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        anchors, counts = np.unique(np.concatenate(held), return_counts=True)
        counts = np.minimum(counts, 2).astype(np.uint8)
        block_bits = min(BLOCK_BITS, cell_bits)
        for row in range(ROWS):
            cells = _cells(anchors, row, cell_bits)
            order = np.argsort(cells, kind="stable")
            cells, ordered = cells[order], counts[order]
            blocks = cells >> block_bits
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            begins, ends = np.r_[0, cuts], np.r_[cuts, len(cells)]
            inner = (cells & ((1 << block_bits) - 1)).astype("<u4")
            yield pa.record_batch(
                [
                    pa.array((blocks[begins] + (row << (cell_bits - block_bits))).tolist(), pa.int64()),
                    pa.array([inner[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    pa.array([ordered[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for piece in pieces(batches, "text"):
            found = _Windows(piece.column("text"), window).selected()
            if len(found):
                held.append(found)
                size += len(found)
            if size >= ANCHORS_HELD:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)

    return run


def _merge_sketches(cell_bits: int):
    """Rows sorted by block: add the partial counts of a block, keep a bit for each cell over one; mostly none, so packed."""
    width = 1 << min(BLOCK_BITS, cell_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(width, np.uint8)

        def ready():
            return pa.record_batch(
                [pa.array([now], pa.int64()), pa.array([zlib.compress(np.packbits(total > 1), 1)], pa.binary())],
                names=["block", "bits"],
            )

        for batch in batches:
            for block, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "counts"))):
                if block != now:
                    if now is not None:
                        yield ready()
                    now, total = block, np.zeros(width, np.uint8)
                at = np.frombuffer(cells, "<u4")
                sums = total[at]
                np.add.at(total, at, np.frombuffer(counts, np.uint8))
                total[at] = np.minimum(np.maximum(total[at], sums), 2)
        if now is not None:
            yield ready()

    return run


def sketch(docs: DataFrame, window: int = WINDOW, cell_bits: int = CELL_BITS) -> bytes:
    """Bits of the merged sketch of all anchors of `docs`; its size depends on `cell_bits` alone."""
    partial = docs.select("text").mapInArrow(
        _partial_sketches(window, cell_bits), "block bigint, cells binary, counts binary"
    )
    blocks = (ROWS << cell_bits) >> min(BLOCK_BITS, cell_bits)
    merged = (
        partial.repartition(min(blocks, 64), "block")
        .sortWithinPartitions("block")
        .mapInArrow(_merge_sketches(cell_bits), "block bigint, bits binary")
    )
    width = (1 << min(BLOCK_BITS, cell_bits)) // 8
    bits = bytearray((ROWS << cell_bits) // 8)
    # Collected: an iterator would come after the shuffle files have gone with their query, and make them again.
    for row in merged.collect():
        bits[row.block * width : (row.block + 1) * width] = zlib.decompress(row.bits)
    return bytes(bits)


def _estimated_repeated(anchors: np.ndarray, bits: np.ndarray, cell_bits: int) -> np.ndarray:
    found = np.ones(len(anchors), bool)
    for row in range(ROWS):
        at = _cells(anchors, row, cell_bits) + (row << cell_bits)
        found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return found


def _runs(flags: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-plus-one of the runs of set flags with equal labels."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    breaks = np.flatnonzero((np.diff(at) != 1) | (label[at[1:]] != label[at[:-1]])) + 1
    return at[np.r_[0, breaks]], at[np.r_[breaks - 1, len(at) - 1]] + 1


_CANDIDATE = pa.schema(
    [
        ("anchor", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()),
        ("stop", pa.int64()), ("windows", pa.binary()),
    ]
)


def _flagged(piece: pa.RecordBatch, window: int, cell_bits: int, bits: np.ndarray):
    """Windows of a piece that the sketch lets through: windows, hashes, flags of those known and of those sent, texts.

    A window that occurs twice in a piece is repeated for certain: it is sent once, as a witness for other pieces.
    So the windows inside one very common passage send a row for each piece of text, not one for each text that holds
    it. Those across its edges differ in each text and are all sent.
    """
    found = _Windows(piece.column("text"), window)
    flags = found.valid.copy()
    flags[flags] = _estimated_repeated(found.anchor[flags], bits, cell_bits)
    if not flags.any():
        return None
    hashes = grams(found.hashes, window, seed=0x5851F42D4C957F2D)
    at = np.flatnonzero(flags)
    _, first, inverse, counts = np.unique(hashes[at], return_index=True, return_inverse=True, return_counts=True)
    known = np.zeros(len(flags), bool)
    known[at[counts[inverse] > 1]] = True
    sent = flags & ~known
    sent[at[first]] = True
    return found, hashes, known, sent, found.words.document[: len(flags)]


def _count_rows(window: int, cell_bits: int, shared: Broadcast):
    """Rows of candidates of each anchor, where a task has several."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        anchors, counts = np.unique(np.concatenate(held), return_counts=True)
        many = counts >= REPORTED
        return pa.record_batch([pa.array(anchors[many].astype(np.int64)), pa.array(counts[many])], names=["anchor", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, held, size = np.frombuffer(shared.value, np.uint8), [], 0
        for piece in pieces(batches, "text"):
            seen = _flagged(piece, window, cell_bits, bits)
            if seen is None:
                continue
            found, _, _, sent, document = seen
            begin, _ = _runs(sent, found.anchor + document.astype(U64))
            held.append(found.anchor[begin])
            size += len(begin)
            if size >= ANCHORS_HELD:
                yield flush(held)
                held, size = [], 0
        if held:
            yield flush(held)

    return run


def _candidates(window: int, cell_bits: int, shared: Broadcast, hot: Broadcast):
    """Runs of windows to be grouped (with their hashes), and runs already found repeated (without).

    The key is the anchor, or the hash of the window itself where the anchor is hot; equal windows have equal keys.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for piece in pieces(batches, "text"):
            seen = _flagged(piece, window, cell_bits, bits)
            if seen is None:
                continue
            found, hashes, known, sent, document = seen
            key = found.anchor
            if len(hot.value):
                near = np.minimum(np.searchsorted(hot.value, key), len(hot.value) - 1)
                key = np.where(hot.value[near] == key, hashes[: len(key)], key)
            k1, k2 = (piece.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            origin = found.words.first[document]
            for chosen, label, send in ((known, document.astype(U64), False), (sent, key + document.astype(U64), True)):
                begin, end = _runs(chosen, label)
                if not len(begin):
                    continue
                owner = document[begin]
                keys = key[begin].astype(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(keys if send else k1[owner]),
                        pa.array(k1[owner]),
                        pa.array(k2[owner]),
                        pa.array(begin - origin[begin]),
                        pa.array(end - origin[begin]),
                        pa.array([hashes[a:b].tobytes() for a, b in zip(begin, end)] if send else [None] * len(begin), pa.binary()),
                    ],
                    schema=_CANDIDATE,
                )

    return run


_REPEATED = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _group_exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key (`anchor`): windows of one key with equal hashes are repeated; known runs pass."""

    def settle(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        k1, k2, start = (table.column(c).to_numpy() for c in ("k1", "k2", "start"))
        anchor = table.column("anchor").to_numpy()
        raw = table.column("windows").to_pylist()
        sizes = np.array([len(x) // 8 for x in raw], dtype=np.int64)
        owner = np.repeat(np.arange(len(raw)), sizes)
        values = np.frombuffer(b"".join(raw), np.uint64)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        order = np.lexsort((values, anchor[owner]))
        same = (np.diff(anchor[owner][order]) == 0) & (np.diff(values[order]) == 0)
        twice = np.zeros(len(order), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        begin, end = _runs(twice, owner)
        row = owner[begin]
        return pa.record_batch(
            [pa.array(k1[row]), pa.array(k2[row]), pa.array(start[row] + place[begin]), pa.array(start[row] + place[begin] + end - begin)],
            schema=_REPEATED,
        )

    rest: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        known = batch.filter(pa.compute.is_null(batch.column("windows")))
        if known.num_rows:
            yield pa.record_batch([known.column(c) for c in _REPEATED.names], schema=_REPEATED)
        batch = batch.filter(pa.compute.is_valid(batch.column("windows")))
        if not batch.num_rows:
            continue
        rest.append(batch)
        size += batch.num_rows
        last = batch.column("anchor")[-1].as_py()
        if size < 20_000 or rest[0].column("anchor")[0].as_py() == last:
            continue
        table = pa.Table.from_batches(rest)
        cut = int(np.searchsorted(table.column("anchor").to_numpy(), last))
        if cut:
            yield settle(table.slice(0, cut))
        rest = table.slice(cut).to_batches()
        size = table.num_rows - cut
    if size:
        yield settle(pa.Table.from_batches(rest))


def candidates(docs: DataFrame, window: int = WINDOW, cell_bits: int = CELL_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs of windows that may be repeated, with the key (`anchor`) that they are grouped by."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(*text_key(), "text")
    shared = context.broadcast(sketch(texts, window, cell_bits))
    counts = texts.mapInArrow(_count_rows(window, cell_bits, shared), "anchor bigint, n bigint")
    many = counts.groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= hot_rows).select("anchor")
    hot = np.sort(many.toArrow().column("anchor").to_numpy().astype(U64))
    return texts.mapInArrow(
        _candidates(window, cell_bits, shared, context.broadcast(hot)),
        "anchor bigint, k1 bigint, k2 bigint, start bigint, stop bigint, windows binary",
    )


def repeated_runs(docs: DataFrame, window: int = WINDOW, cell_bits: int = CELL_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Starts [start, stop) of repeated windows per text (k1, k2); a run may come twice."""
    return (
        candidates(docs, window, cell_bits, hot_rows).repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_group_exactly, "k1 bigint, k2 bigint, start bigint, stop bigint")
    )


def _removed(runs: list, n: int, window: int) -> np.ndarray:
    """Flags of the words that repeated windows cover."""
    edge = np.zeros(n + 1, np.int64)
    for a, b in runs:
        edge[a] += 1
        edge[min(n, b - 1 + window)] -= 1
    return np.cumsum(edge[:-1]) > 0


def _apply(window: int, fields: list[tuple[str, pa.DataType]]):
    schema = pa.schema([*fields, ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, removed, kept = [], [], []
            for text, starts, stops in zip(*(batch.column(c).to_pylist() for c in ("_text", "_starts", "_stops"))):
                tokens = (text or "").encode().split()
                gone = 0
                if starts:
                    flags = _removed(list(zip(starts, stops)), len(tokens), window)
                    gone = int(flags.sum())
                    tokens_kept = [w for w, x in zip(tokens, flags.tolist()) if not x]
                else:
                    tokens_kept = tokens
                words.append(len(tokens))
                removed.append(gone)
                kept.append(b" ".join(tokens_kept).decode())
            yield pa.record_batch(
                [*(batch.column(c) for c, _ in fields), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                schema=schema,
            )

    return run


def remove_repeats(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), window: int = WINDOW, cell_bits: int = CELL_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """`keep` columns of each row with n_words, n_removed, and kept_text (words joined by one space)."""
    from pyspark.sql.pandas.types import to_arrow_type

    # A text's runs are as many as its words at most, however many copies of it there are.
    runs = (
        repeated_runs(docs, window, cell_bits, hot_rows)
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("runs"))
        .select("k1", "k2", F.col("runs.start").alias("_starts"), F.col("runs.stop").alias("_stops"))
    )
    keyed = docs.select(*(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col("text").alias("_text"), *text_key())
    joined = keyed.join(runs, ["k1", "k2"], "left").select(*(f"_{i}" for i in range(len(keep))), "_text", "_starts", "_stops")
    kinds = [docs.schema[c].dataType for c in keep]
    fields = [(f"_{i}", to_arrow_type(kind)) for i, kind in enumerate(kinds)]
    ddl = "".join(f"_{i} {kind.simpleString()}, " for i, kind in enumerate(kinds))
    out = joined.mapInArrow(_apply(window, fields), ddl + "n_words bigint, n_removed bigint, kept_text string")
    return out.withColumnsRenamed({f"_{i}": c for i, c in enumerate(keep)})


def digest(df: DataFrame) -> DataFrame:
    """The digest columns of the query."""
    return df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def brute_force(texts: dict, window: int = WINDOW) -> dict:
    """The same result from plain Python, for small inputs: id -> (words, removed, digest)."""
    words = {k: (t or "").encode().split() for k, t in texts.items()}
    seen: dict[tuple, int] = {}
    for w in words.values():
        for i in range(len(w) - window + 1):
            seen[tuple(w[i : i + window])] = seen.get(tuple(w[i : i + window]), 0) + 1
    out = {}
    for k, w in words.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[k] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    return out


#: The same in SQL: windows as strings of their words, which hold no white space.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  x AS (SELECT r, i, array_to_string(w[i : i + {WINDOW - 1}], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
  h AS (SELECT r, i FROM x WHERE g IN (SELECT g FROM x GROUP BY g HAVING count(*) > 1)),
  gone AS (SELECT DISTINCT r, unnest(range(i, i + {WINDOW})) AS p FROM h),
  words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
  kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS k FROM words ANTI JOIN gone USING (r, p) GROUP BY r),
  n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN n USING (r) LEFT JOIN kept USING (r)
"""
