"""Connected components by contraction: every vertex hooks on its least neighbour, trees shrink to their roots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolefit.llm.common import materialize


def _roots(parents: DataFrame) -> DataFrame:
    """v, root from v, p: pointers are doubled until every one leads to a root; p < v, so there are no cycles."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("up"))
        jumped = materialize(parents.join(up, "p", "left").select("v", F.coalesce("up", "p").alias("p"), F.col("up").isNotNull().alias("moved")), "cc-parents")
        parents = jumped.select("v", "p")
        if jumped.filter("moved").isEmpty():
            return parents.withColumnRenamed("p", "root")


def components(edges: DataFrame) -> DataFrame:
    """v, root of every vertex of ``edges`` (a, b) but the roots: root is the least vertex that v reaches.

    Each pass halves the vertices that have edges at least. A vertex with any number of neighbours costs one row per
    task: the least neighbour is a partial aggregate, and lookups are equi-joins of written tables, split where skewed.
    """
    total = None
    edges = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    while not edges.isEmpty():
        hooked = materialize(edges.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "cc-hooks")
        roots = _roots(hooked)
        if total is None:
            total = roots
        else:
            moved = total.withColumnRenamed("root", "old").join(roots.select(F.col("v").alias("old"), "root"), "old", "left")
            total = materialize(moved.select("v", F.coalesce("root", "old").alias("root")).unionByName(roots), "cc-roots")
        ends = edges.join(roots.select(F.col("v").alias("a"), F.col("root").alias("ra")), "a", "left").join(roots.select(F.col("v").alias("b"), F.col("root").alias("rb")), "b", "left")
        ends = ends.select(F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")).filter("x <> y")
        edges = materialize(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "cc-edges")
    if total is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return total
