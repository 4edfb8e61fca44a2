"""Whitening against plain numpy and whole-number arithmetic."""

import math
import random

import numpy as np
import pytest

from tidemill.llm import whitening


@pytest.mark.parametrize("high", [1, 2, 1000, 10**6, 2**40, 2**62])
def test_cross_products_are_exact(high):
    rand = np.random.default_rng(high % 97)
    x = rand.integers(-high, high, (131, 7), endpoint=True)
    x[:, 3] = 5
    sums, products = whitening.cross_products(x)
    whole = x.astype(object)
    assert sums.tolist() == whole.sum(axis=0).tolist()
    assert (products == whole.T @ whole).all()


def test_no_rows_and_one_row():
    assert whitening.cross_products(np.zeros((0, 3), np.int64))[1].tolist() == [[0] * 3] * 3
    assert whitening.cross_products(np.array([[3, -4]]))[1].tolist() == [[9, -12], [-12, 16]]


def plainly(vectors, count=8):
    """(n, x, covariance) of the vectors that take part, all of one length, by numpy in extended precision."""
    good = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in good], object)
    n = len(x)
    far = n * x - x.sum(axis=0)
    return n, x, np.array(far.T @ far / n**3, float), (far**2).sum(axis=1)


DDL = "vec_id bigint, embedding array<float>, label int, x string, c int, component string, n int"


def table(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, 1, "x", 2, "k", 3) for i, v in enumerate(vectors)], DDL).repartition(parts)


def test_whitened_rows_equal_numpy(spark):
    rand = random.Random(1)
    vectors = [[rand.gauss(0, 0.1 * (j + 1)) + 0.05 * i * (j == 2) for j in range(12)] for i in range(400)]
    vectors += [vectors[0]] * 200  # a vector that a third of the rows share
    odd = [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e30] + [0.0] * 11]
    out = whitening.whiten(table(spark, vectors + odd)).collect()
    n, x, covariance, far = plainly(vectors)
    values, components = np.linalg.eigh(covariance)
    values, components = values[::-1][:8], components[:, ::-1][:, :8]
    assert len(out) == 8 * len(vectors) and {r.n for r in out} == {n}
    centred = (x - x.sum(axis=0) / n).astype(float)
    want = centred @ components / np.sqrt(values)
    got = np.zeros_like(want)
    for r in out:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == int(r.deviation_exact) == far[r.vec_id]
        assert abs(r.explained / (values[r.component - 1] / np.trace(covariance)) - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got - sign * want).max() < 1e-8


def test_lengths_empty_vectors_and_constant_dimensions(spark):
    rand = random.Random(2)
    vectors = [[rand.random(), rand.random(), 0.5] for _ in range(50)] + [[rand.random()] for _ in range(20)] + [[]] * 3 + [[0.25] * 5] * 4
    out = whitening.whiten(table(spark, vectors)).collect()
    assert {(r.vec_id, r.component) for r in out} == {(i, k) for i in range(50) for k in (1, 2)} | {(50 + i, 1) for i in range(20)}
    assert {r.n for r in out if r.vec_id < 50} == {50} and max(r.identity_error for r in out) < 1e-9
    assert whitening.whiten(table(spark, [[1.0, 2.0]])).count() == 0
    assert whitening.whiten(table(spark, vectors).limit(0)).count() == 0


def test_large_entries_stay_exact(spark):
    rand = random.Random(3)
    vectors = [[rand.choice([-1, 1]) * rand.random() * 2.0**40, rand.random()] for _ in range(60)]
    out = whitening.whiten(table(spark, vectors)).collect()
    _, _, _, far = plainly(vectors)
    assert {r.vec_id: int(r.deviation_exact) for r in out} == dict(enumerate(far))
    assert all(r.deviation is None or r.deviation == far[r.vec_id] for r in out) and any(r.deviation is None for r in out)


def test_the_query_covers_its_table(spark, folder):
    from tidemill.llm.queries import op13

    out = whitening.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
    query = op13(spark, folder)
    assert query.columns[:4] == ["vec_id", "component", "n", "deviation"]
    assert query.count() == out.count() == 8 * spark.read.parquet(f"{folder}/embeddings.parquet").count()
