"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Entries become integers. A block of rows is turned sideways: each dimension, shifted by its least value in the block, is
cut into bit planes, and each plane is packed over the rows into 64-bit words. The number of ones in the AND of two
planes, weighted by the two places' powers of two and summed, is the exact cross-product of two dimensions; the shift is
put back in whole numbers. Blocks and tasks add up without rounding (sums travel as two decimals of 64 bits and the
rest), so the covariance is centred as integers, n * sum(x_i * x_j) - s_i * s_j, and rounded once, before `eigh`.

The scatter is one scan with an aggregate of d * (d + 1) / 2 + d + 1 rows, whatever the number of vectors; the driver
gets those sums for each length of vectors and sends back eight components. The covariance of the whitened rows is
measured in a second scan, the result is made in a third; no vector is shuffled.

Defined results: vectors that are null, hold a null, NaN or infinite entry, or one whose integer doesn't fit a long,
take no part. Vectors of different lengths are whitened apart, each length by its own fit list. Repeated rows, and rows
without id, count like any other. Components whose eigenvalue is zero but for rounding (a constant dimension, fewer
distinct vectors than dimensions, a single vector) can't be scaled to one and give no rows, so a fit list of equal
vectors, empty vectors and an empty table give none. A deviation that doesn't fit a long is null; `deviation_exact`
holds it up to 38 digits, null beyond. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Rows in a block of the scatter; a block's planes take rows * dimensions * bits / 8 bytes.
BLOCK_ROWS = 16_384
WORD = 1 << 64


def fit_list(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """vec_id and x = floor(scale * c) + shift of the vectors that take part."""
    whole = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < 2.0**62)
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(column).alias("c"))
        .filter(F.col("c").isNotNull() & F.forall("c", fits))
        .select("vec_id", F.transform("c", lambda x: whole(x).cast("bigint") + F.lit(shift).cast("bigint")).alias("x"))
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) of a batch for each length of its vectors."""
    column = batch.column("x")
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, values[starts[rows][:, None] + np.arange(size)]


def _planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of unsigned columns, packed over rows: (plane words, dimension, bit); zero columns have none."""
    bits = [int(v).bit_length() for v in y.max(axis=0)]
    dimension = np.repeat(np.arange(y.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if dimension.size else dimension
    words = -(-len(y) // 64)
    packed = np.zeros((len(dimension), words * 8), np.uint8)
    for b in range(max(bits, default=0)):
        at = np.flatnonzero(bit == b)
        ones = ((y[:, dimension[at]] >> np.uint64(b)) & np.uint64(1)).astype(np.uint8)
        packed[at, : -(-len(y) // 8)] = np.packbits(ones, axis=0).T
    return packed.view(np.uint64), dimension, bit


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums of x_i and of x_i * x_j over the rows of a long matrix, as Python integers."""
    n, d = x.shape
    if not n or not d:
        return np.zeros(d, object), np.zeros((d, d), object)
    low = x.min(axis=0)
    y = x.astype(np.uint64) - low.astype(np.uint64)  # wraps to the true difference
    planes, dimension, bit = _planes(y)
    ones = np.bitwise_count(planes).sum(axis=1, dtype=np.int64).astype(object)
    counts = np.zeros((len(planes), len(planes)), np.int64)
    for k in range(len(planes)):
        counts[k, k:] = np.bitwise_count(planes[k] & planes[k:]).sum(axis=1, dtype=np.int64)
    counts += np.triu(counts, 1).T
    power = np.array([1 << int(b) for b in bit], object)
    if bit.size and 2 * (int(bit.max()) + 1) + n.bit_length() < 63:
        weighted = counts * np.outer(power.astype(np.int64), power.astype(np.int64))
    else:
        weighted = counts.astype(object) * np.outer(power, power)
    # Add up the planes of each dimension; a dimension without planes adds nothing.
    has, first = np.unique(dimension, return_index=True)
    products, sums = np.zeros((d, d), object), np.zeros(d, object)
    if has.size:
        folded = np.add.reduceat(np.add.reduceat(weighted, first, axis=0), first, axis=1)
        products[np.ix_(has, has)] = folded.astype(object)
        sums[has] = np.add.reduceat(ones * power, first)
    shift = np.array([int(v) for v in low], object)
    return sums + n * shift, products + np.outer(shift, sums) + np.outer(sums, shift) + n * np.outer(shift, shift)


_SCATTER = pa.schema([("d", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38)), ("low", pa.decimal128(38))])


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (d, i, j, sum) for each pair of dimensions; i = -1 for the sums of dimension j, i = j = -1 for the rows."""
    held: dict[int, list] = {}
    for batch in batches:
        for _, x in _matrices(batch):
            for start in range(0, len(x), BLOCK_ROWS):
                block = x[start : start + BLOCK_ROWS]
                sums, products = cross_products(block)
                one = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object), np.zeros((x.shape[1],) * 2, object)])
                one[0], one[1], one[2] = one[0] + len(block), one[1] + sums, one[2] + products
    for d, (n, sums, products) in held.items():
        i, j = np.triu_indices(d)
        total = np.r_[np.array([n], object), sums, products[i, j]]
        # value = high * 2**64 + low, with low in [0, 2**64)
        parts = [divmod(int(v), WORD) for v in total]
        columns = [
            pa.array(np.full(len(total), d, np.int32)),
            pa.array(np.r_[-1, np.full(d, -1), i].astype(np.int32)),
            pa.array(np.r_[-1, np.arange(d), j].astype(np.int32)),
            *(pa.array([Decimal(p[k]) for p in parts], pa.decimal128(38)) for k in (0, 1)),
        ]
        yield pa.record_batch(columns, schema=_SCATTER)


@dataclass
class Whitener:
    """What whitens the vectors of one length: exact sums, components scaled to unit variance, and their shares."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int], products: np.ndarray, count: int) -> Whitener:
        s = np.array(sums, object)
        centred = n * products - np.outer(s, s)
        square = n * n
        covariance = np.array([[int(v) / square for v in row] for row in centred], float).reshape(len(s), len(s))
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:count]
        values, vectors, trace = values[order], vectors[:, order], float(np.trace(covariance))
        kept = values > max(trace, 0.0) * len(s) * np.finfo(float).eps
        return cls(n, sums, vectors[:, kept].T, values[kept], values[kept] / trace if trace else values[kept])

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """(rows, components): (x - s / n) on each component, over its standard deviation."""
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums))
        centred = (x - np.array(whole, np.int64)).astype(float) - np.array([r / self.n for r in rest])
        return centred @ self.components.T / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum((n * x - s)**2) of each row, exact."""
        far = max(max(abs(self.n * int(v) - s) for v in (low, high)) for low, high, s in zip(x.min(axis=0), x.max(axis=0), self.sums))
        if far * far * len(self.sums) < 1 << 63 and self.n * int(np.abs(x).max()) < 1 << 63:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1).tolist()
        return ((self.n * x.astype(object) - np.array(self.sums, object)) ** 2).sum(axis=1).tolist()


def fit(rows: DataFrame, count: int = COMPONENTS) -> dict[int, Whitener]:
    """A whitener for each length of vectors; `rows` has x. The driver gets one number a pair of dimensions."""
    sums = (
        rows.select("x")
        .mapInArrow(_scatter, "d int, i int, j int, high decimal(38,0), low decimal(38,0)")
        .groupBy("d", "i", "j")
        .agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
        .collect()
    )
    found: dict[int, dict] = {}
    for r in sums:
        found.setdefault(r.d, {})[r.i, r.j] = int(r.high) * WORD + int(r.low)
    out = {}
    for d, values in found.items():
        if not d:
            continue
        products = np.zeros((d, d), object)
        for (i, j), value in values.items():
            if i >= 0:
                products[i, j] = products[j, i] = value
        out[d] = Whitener.of(values[-1, -1], [values[-1, j] for j in range(d)], products, count)
    return out


def identity_errors(rows: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """For each length the largest absolute entry of the whitened rows' covariance less the identity, as measured."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for _, x in _matrices(batch):
                if (model := shared.value.get(x.shape[1])) is not None:
                    w = model.whiten(x)
                    one = held.setdefault(x.shape[1], [0.0, 0.0])
                    one[0], one[1] = one[0] + w.sum(axis=0), one[1] + w.T @ w
        for d, (first, second) in held.items():
            k = len(first)
            i, j = np.r_[np.full(k, -1), np.repeat(np.arange(k), k)], np.r_[np.arange(k), np.tile(np.arange(k), k)]
            columns = [np.full(len(i), d, np.int32), i.astype(np.int32), j.astype(np.int32), np.r_[first, second.reshape(-1)]]
            yield pa.record_batch([pa.array(c) for c in columns], names=["d", "i", "j", "v"])

    measured = rows.select("x").mapInArrow(moments, "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    values = {(r.d, r.i, r.j): r.v for r in measured.collect()}
    out = {}
    for d, model in models.items():
        k = range(len(model.eigenvalues))
        mean = [values[d, -1, j] / model.n for j in k]
        out[d] = max((abs(values[d, i, j] / model.n - mean[i] * mean[j] - (i == j)) for i in k for j in k), default=0.0)
    return out


_OUT = pa.schema(
    [
        ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
        ("deviation_exact", pa.decimal128(38)), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
    ]
)
_OUT_DDL = (
    "vec_id bigint, component int, n bigint, deviation bigint, deviation_exact decimal(38,0), "
    "whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, column: str = "embedding", count: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row for each vector that takes part and each component: see the columns of `_OUT`."""
    rows = fit_list(vectors, column, scale, shift)
    models = fit(rows, count)
    errors = identity_errors(rows, models)
    shared = rows.sparkSession.sparkContext.broadcast((models, errors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, errors = shared.value
        for batch in batches:
            for at, x in _matrices(batch):
                model = models.get(x.shape[1])
                k = 0 if model is None else len(model.eigenvalues)
                if not k:
                    continue
                far = model.deviations(x)
                ids = batch.column("vec_id").take(pa.array(np.repeat(at, k)))
                narrow = [v if v < 1 << 63 else None for v in far]
                exact = [Decimal(v) if v < 10**38 else None for v in far]
                spread = pa.array(np.repeat(np.arange(len(at)), k))
                yield pa.record_batch(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(at) * k, model.n)),
                        pa.array(narrow, pa.int64()).take(spread),
                        pa.array(exact, pa.decimal128(38)).take(spread),
                        pa.array(model.whiten(x).reshape(-1)),
                        pa.array(np.tile(model.explained, len(at))),
                        pa.array(np.full(len(at) * k, errors[x.shape[1]])),
                    ],
                    schema=_OUT,
                )

    return rows.mapInArrow(run, _OUT_DDL)
