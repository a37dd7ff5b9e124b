"""Connected components by alternating star contraction.

Every round rewires each edge towards the smallest node its end knows (first
from the larger neighbours, then from the smaller), until each component is a
star around its smallest node.  A round is two aggregates with a join back,
so a node with a third of all edges is pre-aggregated map-side and its join is
split by AQE.  Each round's edges are written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minekit.session import materialize


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.coalesce(F.sum(F.xxhash64("a", "b") % (1 << 31)), F.lit(0)).alias("s")).first()
    return r.n, r.s


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node that has
    an edge to another node; ``edges`` has long columns ``a, b``."""
    e = materialize(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        e = materialize(small, "edges")
        state, before = _state(e), state
        if state == before:
            break
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
