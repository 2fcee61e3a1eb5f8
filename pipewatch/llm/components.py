"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewatch.llm.common import saved

#: Steps after which the search gives up; they grow with the logarithm of a component's size.
MOST_STEPS = 60


def _minima(e: DataFrame) -> DataFrame:
    """Of each node the least neighbour, how many neighbours are smaller, and whether one is larger."""
    of = e.groupBy("u").agg(F.min("v").alias("m"), F.sum((F.col("v") < F.col("u")).cast("int")).alias("o"), F.max((F.col("v") > F.col("u")).cast("int")).alias("i"))
    return saved(of, "cc_minima")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every
    node of ``edges`` (two whole-number columns).  Loops, repeats, either
    direction and null ends (no edge) are allowed; no edges, no rows.

    Each step joins edges with the least neighbour of each node.  The least
    neighbours are written first, so a node with very many edges is an
    ordinary skewed join, which adaptive execution splits; nothing is
    collected but two maxima that tell whether all components are stars."""
    e = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = saved(e.where("u != v").select("u", "v").distinct(), "cc_edges")
    for _ in range(MOST_STEPS):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _minima(both)
        # Done when every node has one smaller neighbour at most, and no node is both a root and below one.
        most = low.agg(F.max("o"), F.max(F.col("o") * F.col("i"))).first()
        if (most[0] or 0) <= 1 and not most[1]:
            break
        # Large star: every larger neighbour moves to the least of the neighbours and the node itself.
        low = low.select("u", F.least("u", "m").alias("m"))
        e = saved(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "cc_large")
        # Small star: the smaller neighbours, and the node, move to the least of them.
        low = _minima(e).select("u", "m")
        moved = e.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc_small")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
