"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.runtime import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on each node's least neighbour: the larger ones, or the smaller and itself."""
    near = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    if large:
        least = materialize(least, "least")
    joined = near.join(least, F.col("u") == F.col("c")).select("u", "v", "m")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return out.filter(F.col("u") != F.col("v"))


def _is_star(edges: DataFrame) -> bool:
    """Whether every node either hangs on one other or has others hanging on it, not both."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).union(edges.select("v", F.lit(0), F.lit(1)))
    odd = ends.groupBy("n").agg(F.sum("hangs").alias("hangs"), F.sum("holds").alias("holds")).filter("hangs > 1 or (hangs > 0 and holds > 0)")
    return odd.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b), the label being its component's least node.

    Rounds are logarithmic in the longest path; only edges move, a node's neighbours never
    meet in one task but as partial minima; those of a large star are written before edges
    are joined to them, so that Spark splits a hub's edges over tasks. Each round is written, so lineage
    stays short. The driver sees one number a round. An empty table gives none.
    """
    now = materialize(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _is_star(now):
        before, now = now, materialize(_star(_star(now, True), False).distinct(), "edges")
        discard(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
