"""Connected components of an edge table, by hooking to smaller neighbours and contraction, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.tables import scratch, stage


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), staged; the root is one node of the component.

    Each round every node with a smaller neighbour hooks to the smallest; chains are shortened until all point to
    roots; edges between different roots remain. Rounds end when none does, which is after few, as each round at least
    halves the nodes of a component that is left. A node of many edges is combined before the shuffle.

    `known` is the result for other edges: their nodes are in the result too, and only what `edges` adds is worked on.
    """
    with scratch(edges.sparkSession, "components") as folder:
        if known is None:
            return stage(_found(edges, folder), "component-roots")
        of = lambda side: known.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        met = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
        more = _found(met.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")), folder)
        up = more.select(F.col("node").alias("root"), F.col("root").alias("above"))
        moved = known.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
        return stage(moved.unionByName(more.join(known.select("node"), "node", "left_anti")), "component-roots")


def _found(edges: DataFrame, folder: str) -> DataFrame:
    """The components, still in tables of the folder."""
    edges = edges.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).filter("a <> b").distinct()
    edges = stage(edges, "component-edges", folder)
    found = None
    while not edges.isEmpty():
        parents = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        ends = edges.select(F.col("b").alias("node")).distinct().join(parents.select("node"), "node", "left_anti")
        step = stage(parents.unionByName(ends.withColumn("root", F.col("node"))), "component-step", folder)
        while True:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("above"))
            moved = step.join(up, "root", "left").select("node", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved"))
            moved = stage(moved, "component-step", folder)
            step = moved.select("node", "root")
            if moved.filter("moved").isEmpty():
                break
        if found is None:
            found = step
        else:
            up = step.select(F.col("node").alias("root"), F.col("root").alias("above"))
            found = found.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
            found = stage(found, "component-found", folder)
        of = lambda side: step.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))  # noqa: E731, B023
        edges = edges.join(of("a"), "a").join(of("b"), "b").select(
            F.least("root_a", "root_b").alias("b"), F.greatest("root_a", "root_b").alias("a")
        )
        edges = stage(edges.filter("a <> b").distinct(), "component-edges", folder)
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
