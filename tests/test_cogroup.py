"""A function over both sides of a key, in chunks."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from helpers import rows

from tidemill.operators.cogroup import CoGroupStep, PairByRank, co_group_apply


def sides(spark, n=400, seed=1):
    rnd = random.Random(seed)
    left = [(rnd.choice(["h", "h", "a", "b", None, "l"]), i, rnd.choice([*range(9), None])) for i in range(n)]
    right = [(rnd.choice(["h", "a", None, "r"]), i, rnd.randrange(9)) for i in range(n // 2)]
    return left, right, spark.createDataFrame(left, "k string, lid bigint, lv bigint"), spark.createDataFrame(right, "k string, rid bigint, rv bigint")


@pytest.mark.parametrize("chunk", [2, 7, 10_000])
def test_pairs_by_rank(spark, chunk):
    left, right, ldf, rdf = sides(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        out = co_group_apply(
            ldf, rdf, ["k"], "lid", "rid", lambda: PairByRank("lid", "rid", "lv", "rv"), "pair bigint, lid bigint, rid bigint, balance bigint", 64
        )
        got = rows(out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    want = []
    for key in {r[0] for r in left + right}:
        balance = 0
        pairs = itertools.zip_longest([r for r in left if r[0] == key], [r for r in right if r[0] == key], fillvalue=(key, None, 0))
        for i, (a, b) in enumerate(pairs, 1):
            balance += (a[2] or 0) - b[2]
            want.append((key, i, a[1], b[1], balance))
    assert got == sorted(want, key=repr)


def sizes():
    """Made inside a function, so that workers get the class itself: they can't import this module."""

    class Sizes(CoGroupStep):
        def __init__(self):
            self.seen, self.largest = [0, 0], 0

        def feed(self, left, right):
            self.seen = [n + t.num_rows for n, t in zip(self.seen, (left, right))]
            self.largest = max(self.largest, left.num_rows + right.num_rows)

        def finish(self):
            import pyarrow as pa

            return pa.table({"n_left": [self.seen[0]], "n_right": [self.seen[1]], "largest": [self.largest]})

    return Sizes


def test_chunks_stay_small_and_results_come_at_the_end(spark):
    left, right, ldf, rdf = sides(spark, 3000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        out = co_group_apply(ldf, rdf, ["k"], "lid", "rid", sizes(), "n_left int, n_right int, largest int").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    count = lambda data, key: sum(r[0] == key for r in data)
    assert {x.k: (x.n_left, x.n_right) for x in out} == {key: (count(left, key), count(right, key)) for key in {r[0] for r in left + right}}
    assert max(x.largest for x in out) <= 52


def test_columns_of_both_sides_are_refused(spark):
    _, _, ldf, _ = sides(spark)
    with pytest.raises(ValueError, match="both sides"):
        co_group_apply(ldf, ldf, ["k"], "lid", "lid", sizes(), "n_left int")


def test_whole_keys_are_taken_together(spark):
    """A key costs no call of its own where it lies whole in a batch; those at its ends go on in the next one."""

    class Counting(PairByRank):
        def feed(self, left, right):
            raise_at.append(1)
            return super().feed(left, right)

    import pyarrow as pa

    raise_at = []
    step = Counting("lid", "rid", "lv", "rv")
    rows = [("a", 1, 0, 10, 5, None, None), ("a", 1, 1, None, None, 20, 2), ("a", 2, 1, None, None, 21, 3), ("b", 1, 0, 11, None, None, None)]
    names = ["k", "rank", "from_right", "lid", "lv", "rid", "rv"]
    kinds = [pa.string(), *[pa.int64()] * 6]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
    out, key = step.many(table, np.array([0, 3]))
    assert out.to_pylist() == [
        {"pair": 1, "lid": 10, "rid": 20, "balance": 3},
        {"pair": 2, "lid": None, "rid": 21, "balance": 0},
        {"pair": 1, "lid": 11, "rid": None, "balance": 0},
    ]
    assert list(key) == [0, 0, 1] and not raise_at


@pytest.mark.parametrize("chunk", [3, 50, 10_000])
def test_many_small_keys(spark, chunk):
    left = [(i % 300, i, i % 7) for i in range(1000)]
    right = [(i % 211, i, i % 5) for i in range(700)]
    ldf, rdf = spark.createDataFrame(left, "k long, lid long, lv long"), spark.createDataFrame(right, "k long, rid long, rv long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    try:
        out = co_group_apply(
            ldf, rdf, ["k"], "lid", "rid", lambda: PairByRank("lid", "rid", "lv", "rv"), "pair bigint, lid bigint, rid bigint, balance bigint", 64
        )
        got = rows(out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    want = []
    for key in range(300):
        balance = 0
        pairs = itertools.zip_longest([r for r in left if r[0] == key], [r for r in right if r[0] == key], fillvalue=(key, None, 0))
        for i, (a, b) in enumerate(pairs, 1):
            balance += a[2] - b[2]
            want.append((key, i, a[1], b[1], balance))
    assert got == sorted(want, key=repr)
