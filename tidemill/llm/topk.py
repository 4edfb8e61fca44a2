"""Exact top-k by inner product with a vector-approximation file.

Every vector is stored a second time as small cells: an equal-width grid of 2**bits cells in each dimension. A scan of
the cells alone bounds each score from both sides. Then exact vectors are read in the order of their bounds: first the
k best upper bounds of each query, then only those whose upper bound reaches the k-th exact score so far. What is left
out can't be among the k best.

Queries and candidates meet in blocks (one equi-join on the number of the query block), so a task holds one block of
each. Equal vectors are one class in the search: a class keeps its k + 1 smallest ids, one more than needed as a query
doesn't find itself. So a vector that a third of the rows share costs k + 1 rows.

Defined results: vectors that are null, hold a null, NaN or infinite component, or a component that doesn't fit a long
after scaling take no part, and neither does a row without id. Vectors of different lengths don't meet. Ties go to the
smaller id. Every row is a candidate, of all queries but itself: repeated rows fill a rank each, and repeated queries
are answered each. A score that doesn't fit a long is not returned. Fewer than k candidates give fewer rows; a query
without any candidate gives none. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.tables import stage

K = 5
BITS = 6
#: Queries in a query block; vectors in a candidate block.
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 8192


def scaled(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row, vec_id and floor(scale * x) as longs, for the vectors that take part; rows are numbered, so stage the result."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    good = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < 2.0**62))
    return (
        vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
        .filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & good)
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"),
        )
    )


def _grid(classes: DataFrame) -> DataFrame:
    """Lowest and highest value of each dimension of each length."""
    return (
        classes.select(F.size("v").alias("dim"), F.posexplode("v").alias("axis", "x"))
        .groupBy("dim", "axis")
        .agg(F.min("x").alias("low"), F.max("x").alias("high"))
        .groupBy("dim")
        .agg(F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("g"))
        .select("dim", F.col("g.low").alias("low"), F.col("g.high").alias("high"))
    )


def _cells(v: Column, low: Column, high: Column, bits: int) -> Column:
    """The cell of each component, as bytes written in hex by component."""
    cell = lambda x, i: F.floor(
        (x.cast("double") - F.get(low, i)) * (1 << bits) / (F.get(high, i).cast("double") - F.get(low, i) + 1)
    )
    return F.transform(v, lambda x, i: cell(x, i).cast("tinyint"))


def _matrix(column: pa.ListArray, kind) -> np.ndarray:
    rows = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    return values.reshape(rows, -1)


def _bounds(k: int, bits: int):
    """For each (query block, candidate block): the candidates whose upper bound reaches the k-th lower bound."""
    schema = pa.schema([("query_id", pa.int64()), ("class_id", pa.int64()), ("lower", pa.float64()), ("upper", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part = batch.slice(row, 1)
                low, high = (np.array(part.column(c)[0].as_py(), np.float64) for c in ("low", "high"))
                queries = part.column("queries")[0].values
                candidates = part.column("candidates")[0].values
                q = _matrix(queries.field("v"), np.float64)
                cells = _matrix(candidates.field("cells"), np.float64)
                ids, own = candidates.field("class_id").to_numpy(), queries.field("class_id").to_numpy()
                spare = candidates.field("members").to_numpy()
                asks = queries.field("row").to_numpy()
                width = (high - low + 1) / (1 << bits)
                middle = low + (cells + 0.5) * width
                score = q @ middle.T if q.shape[1] else np.zeros((len(q), len(cells)))
                # Half a cell to either side, and what rounding may add.
                slack = np.abs(q) @ (width / 2) if q.shape[1] else np.zeros(len(q))
                slack = slack * (1 + 1e-9) + 1e-9 * (np.abs(q) @ np.maximum(abs(low), abs(high)) if q.shape[1] else 0) + 1e-6
                # A class that holds only the query itself is none of its candidates.
                score[(own[:, None] == ids[None, :]) & (spare[None, :] < 2)] = -np.inf
                if score.shape[1] > k:
                    # A score that may not fit a long is not returned, so it is no bound for others.
                    counted = np.where(np.abs(score) + slack[:, None] < 2.0**63, score, -np.inf)
                    floor = np.partition(counted, score.shape[1] - k, axis=1)[:, -k] - slack
                else:
                    floor = np.full(len(q), -np.inf)
                at, who = np.nonzero((score + slack[:, None] >= floor[:, None]) & np.isfinite(score))
                found = score[at, who]
                yield pa.record_batch(
                    [pa.array(asks[at]), pa.array(ids[who]), pa.array(found - slack[at]), pa.array(found + slack[at])], schema=schema
                )

    return run


def _product(a: str, b: str) -> Column:
    """The inner product, null where it doesn't fit a long."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.try_multiply(x, y)), F.lit(0).cast("bigint"), lambda s, x: F.try_add(s, x))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 256, bits: int = BITS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each vector where `is_query`."""
    # One staged table of classes: the smallest ids of each distinct vector; the limit on ranks works before the shuffle.
    by_vector = Window.partitionBy("v").orderBy("vec_id", "row")
    every = stage(scaled(vectors, scale), "topk-vectors")
    members = stage(
        every.withColumn("place", F.row_number().over(by_vector)).filter(F.col("place") <= k + 1), "topk-members"
    )
    classes = stage(
        members.groupBy("v").agg(F.min("row").alias("class_id"), F.count("*").alias("members")), "topk-classes"
    )
    grid = stage(_grid(classes), "topk-grid")
    asked = every.filter(is_query).join(classes, "v").withColumn("dim", F.size("v"))

    block = lambda rows, size: F.pmod(F.xxhash64(rows), F.lit(size))
    counts = classes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"))
    query_counts = asked.groupBy("dim").agg(F.count("*").alias("nq"))
    sizes = stage(grid.join(counts, "dim").join(query_counts, "dim"), "topk-sizes")
    blocks_of = lambda n, size: F.ceil(F.col(n) / size).cast("bigint")

    query_blocks = (
        asked.join(sizes.select("dim", "nq"), "dim")
        .withColumn("qb", block("row", 1 << 40) % blocks_of("nq", QUERY_BLOCK))
        .groupBy("dim", "qb")
        .agg(F.collect_list(F.struct("row", "class_id", "v")).alias("queries"))
    )
    candidate_blocks = (
        classes.withColumn("dim", F.size("v"))
        .join(sizes, "dim")
        .withColumn("cb", block("class_id", 1 << 40) % blocks_of("n", CANDIDATE_BLOCK))
        .select("dim", "cb", "low", "high", "nq", "class_id", "members", _cells(F.col("v"), F.col("low"), F.col("high"), bits).alias("cells"))
        .groupBy("dim", "cb")
        .agg(
            F.first("low").alias("low"), F.first("high").alias("high"), F.first("nq").alias("nq"),
            F.collect_list(F.struct("class_id", "members", "cells")).alias("candidates"),
        )
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks_of("nq", QUERY_BLOCK) - 1)))
    )
    bounded = stage(
        candidate_blocks.join(query_blocks, ["dim", "qb"])
        .select("low", "high", "queries", "candidates")
        .mapInArrow(_bounds(k, bits), "query_id bigint, class_id bigint, lower double, upper double"),
        "topk-bounds",
    )

    by_bound = Window.partitionBy("query_id").orderBy(F.desc("upper"), "class_id")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "row")
    asked_by = asked.select(F.col("row").alias("query_id"), F.col("v").alias("q"), F.col("vec_id").alias("asked_id"))
    vectors_of = lambda pairs: (
        pairs.join(classes.select("class_id", "v"), "class_id")
        .join(asked_by, "query_id")
        .join(members.select("v", "vec_id", "row"), "v")
        .filter(F.col("row") != F.col("query_id"))
        .select("query_id", "asked_id", "vec_id", "row", _product("q", "v").alias("score"))
        .filter("score is not null")
    )
    best = bounded.withColumn("place", F.row_number().over(by_bound)).filter(F.col("place") <= k)
    near = stage(vectors_of(best.select("query_id", "class_id")), "topk-first")
    # The k-th exact score so far; a query with fewer has none, and reads all that is left.
    kth = (
        near.withColumn("place", F.row_number().over(by_score))
        .filter(F.col("place") == k)
        .select("query_id", F.col("score").alias("kth"))
    )
    rest = (
        bounded.join(best.select("query_id", "class_id"), ["query_id", "class_id"], "left_anti")
        .join(kth, "query_id", "left")
        .filter(F.col("kth").isNull() | (F.col("upper") >= F.col("kth")))
    )
    found = near.unionByName(vectors_of(rest.select("query_id", "class_id")))
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .filter(F.col("rank") <= k)
        .select(F.col("asked_id").alias("query_id"), "rank", "vec_id", "score")
    )


ORACLE = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY asked ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.r AS asked, q.vec_id AS query_id, c.vec_id AS vec_id,
      CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0))
WHERE rank <= 5
"""
