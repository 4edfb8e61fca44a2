"""Words of Arrow text columns as numpy spans and hashes, one array pass over the bytes of a batch."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
#: Bytes of text handled at once; a longer text is handled alone and whole.
PIECE_BYTES = 2 << 20

#: Word classes by byte. All bytes of a multi-byte character are over 0x7F.
NOT_SPACE = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
ALPHANUMERIC = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b > 0x7F for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def random_row(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - at[0] if len(at) else np.zeros(1, np.int64)


def pieces(batches, *columns: str, limit: int = PIECE_BYTES):
    """Cut record batches so that the text of a piece stays near `limit` bytes; every row is in one piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False) for c in columns)
        ends, start = np.cumsum(lengths, dtype=np.int64), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """Spans of the words of a text column: starts, ends, and where each text's words begin in them."""

    def __init__(self, column: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False):
        self.raw, self.offsets = text_buffer(column)
        self.bytes = LOWER[self.raw] if lower else self.raw
        inside = np.zeros(len(self.raw) + 1, dtype=bool)
        inside[:-1] = kind[self.raw]
        begins = inside[:-1].copy()
        begins[1:] &= ~inside[:-2]
        edges = self.offsets[1:-1]
        edges = edges[edges < len(self.raw)]
        begins[edges] |= inside[edges]
        finish = inside[:-1] & ~inside[1:]
        before = self.offsets[1:-1] - 1
        before = before[before >= 0]
        finish[before] |= inside[before]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def document(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A 64-bit hash of each word; equal words have equal hashes in any batch and on any machine."""
        if not len(self):
            return np.zeros(0, U64)
        lengths = self.ends - self.starts
        at = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(at, lengths)
        values = self.bytes[place + np.repeat(self.starts, lengths)].astype(U64)
        values += U64(1)
        values *= random_row(int(lengths.max()), seed)[place]
        return mix(np.add.reduceat(values, at) + lengths.astype(U64) * U64(0xD6E8FEB86659FD93))


def grams(hashes: np.ndarray, n: int, seed: int = 0x2545F4914F6CDD1D) -> np.ndarray:
    """Hashes of all runs of n values (also across texts: the caller masks those), by doubling."""
    base = np.uint64(seed | 1)
    if len(hashes) < n:
        return np.zeros(0, U64)
    total, done, power = None, 0, U64(1)
    step, step_power, width = hashes, base, 1  # step: hashes of `width` values; step_power: base ** width
    with np.errstate(over="ignore"):
        while width <= n:
            if n & width:
                part = step[done : done + len(hashes) - n + 1] * power
                total = part if total is None else total + part
                done, power = done + width, power * step_power
            if width * 2 <= n:
                step = step[:-width] + step[width:] * step_power
            step_power, width = step_power * step_power, width * 2
    return mix(total)


def sliding_min(values: np.ndarray, n: int) -> np.ndarray:
    """Minima of all runs of n values."""
    if len(values) < n:
        return values[:0]
    width = 1
    while width * 2 <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (n - width)], values[n - width :]) if n > width else values


def complete(words: Words, n: int) -> np.ndarray:
    """Whether the run of n words that starts at each word lies in one text (as many flags as runs)."""
    last = np.repeat(words.first[1:], words.counts)
    return (np.arange(len(words)) + n <= last)[: max(0, len(words) - n + 1)]
