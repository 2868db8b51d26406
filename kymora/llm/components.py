"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is a minimum per node, joined back to the edges: partial minima are taken before the shuffle
and the join's hot nodes are split by AQE, so a node that a third of all edges touch is never one task.
Every round is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kymora.llm.common import stage


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (a, b) with a > b."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter("a > b").distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(down, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(down.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), the root being the least node reachable.

    Nodes without an edge do not appear; loops and repeated edges are harmless.
    """
    now = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct())
    mark = None
    while True:
        got = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
        if tuple(got) == mark or not got[0]:
            break
        mark = tuple(got)
        now = stage(_stars(now))
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select(F.col("b").alias("node"), F.col("b").alias("root")))
