"""Links among the members of buckets without comparing all of a bucket's pairs, for similarity joins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.components import components
from tidemill.llm.tables import stage


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.greatest("c", "d").alias("a"), F.least("c", "d").alias("b")).distinct()


def bucket_links(
    members: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    alike: Callable[[Column, Column], Column],
    name: str,
    pivot_rounds: int = 2,
    sketches: DataFrame | None = None,
    near: Callable[[str, str], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Roots (node, root) of the components that all links within buckets make, and the tested pairs (a, b, linked).

    `members` is a staged table of key, c, size. `alike` of two sizes is false where they rule a link out; `verified`
    tells of pairs (a, b) whether they are linked. First all members of a bucket meet one of them, then those in other
    components than the member of most links meet that one; what is apart after these rounds is compared pair by pair,
    so a bucket of linked members costs a pair a member. Every link within a bucket joins two members of one component.

    `sketches` has c and columns from which `near`, given the names of both sides, tells in the last join itself that two
    members can't be linked; only pairs that pass become rows.
    """
    every = members.groupBy("key").agg(F.min(F.struct("c", "size")).alias("p"), F.count("*").alias("n")).filter("n > 1")
    met = members.join(every.select("key", "p"), "key").filter(F.col("c") != F.col("p.c"))
    first = met.select("c", "size", F.col("p.c").alias("d"), F.col("p.size").alias("other"))
    tested = stage(verified(_pairs(first.filter(alike(F.col("size"), F.col("other"))))), f"{name}-links")
    for turn in range(1, pivot_rounds + 1):
        links = tested.filter("linked")
        roots = components(links.select("a", "b"))
        placed = members.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        apart = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y").select("key")
        placed = stage(placed.join(apart, "key").select("key", "c", "size", "root"), f"{name}-apart")
        if placed.isEmpty():
            return roots, tested
        if turn < pivot_rounds:
            degree = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count("*").alias("links"))
            ranked = placed.join(degree, "c", "left").withColumn("links", F.coalesce("links", F.lit(0)))
            pivots = ranked.groupBy("key").agg(F.max(F.struct("links", "c", "root", "size")).alias("p"))
            rows = placed.join(pivots, "key").filter(F.col("root") != F.col("p.root"))
            rows = rows.select("c", "size", F.col("p.c").alias("d"), F.col("p.size").alias("other"))
        else:
            held = placed if sketches is None else placed.join(sketches, "c")
            left, right = held.alias("l"), held.alias("r")
            on = (F.col("l.key") == F.col("r.key")) & (F.col("l.c") < F.col("r.c")) & (F.col("l.root") != F.col("r.root"))
            on &= alike(F.col("l.size"), F.col("r.size"))
            rows = left.join(right, on if near is None else on & near("l", "r"))
            rows = rows.select(F.col("l.c").alias("c"), F.col("l.size").alias("size"), F.col("r.c").alias("d"), F.col("r.size").alias("other"))
        pairs = _pairs(rows.filter(alike(F.col("size"), F.col("other"))))
        more = verified(pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"))
        tested = stage(tested.unionByName(more), f"{name}-links")
    return components(tested.filter("linked").select("a", "b")), tested
