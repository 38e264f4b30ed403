"""Connected components of a graph that no machine holds whole.

Alternating large-star and small-star steps. A step joins every edge with the
smallest neighbour of one of its ends, which is an aggregation with map-side
combine; the join's hot ends (a star around the smallest node) are rows of one
side only, so adaptive execution splits them. Each round is a written table, so
its lineage is cut and a lost executor costs at most one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of the edges ``a``, ``b`` (longs).

    Loops and repeated edges are allowed, null ends are ignored. Nodes without
    an edge to another node are not returned.
    """
    edges = stored(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
