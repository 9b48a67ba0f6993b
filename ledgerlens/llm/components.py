"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _priority(col: Column) -> Column:
    return F.struct(F.xxhash64(col).alias("h"), col.alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; one root per component.

    Each round every node takes its neighbour of smallest hashed priority
    (or itself) as parent, and the edges are rewritten to parents.  The
    hashed order makes long chains shrink by a constant share per round, so
    the rounds grow with the logarithm of the graph.  Parents are a map-side
    ``min``, so a node with very many edges does not meet in one task.
    Empty input gives an empty result; loops and repeated edges are ignored.
    """
    left = materialise(
        edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "edges")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min(_priority(F.col("b"))).alias("n"))
        parent = materialise(
            nearest.select(F.col("a").alias("node"),
                           F.least(F.col("n"), _priority(F.col("a"))).getField("v").alias("parent")), "parents")
        pa = parent.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        pb = parent.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        left = materialise(
            left.join(pa, "a").join(pb, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = parent.withColumnRenamed("parent", "root")
        else:
            step = parent.select(F.col("node").alias("root"), F.col("parent"))
            labels = labels.join(step, "root", "left").select(
                "node", F.coalesce("parent", "root").alias("root"))
    if labels is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialise(labels, "components")
