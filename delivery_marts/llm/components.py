"""Connected components of a graph given as edges, by rounds of star contraction.

Each round makes every node point at the smallest node among its neighbours, first for larger
neighbours, then for smaller ones; the edges shrink to one star per component, whose centre is
its smallest node, in a number of rounds that grows with the logarithm of the longest chain.
Smallest neighbours are found by an aggregate (combined before the shuffle, so a hub's edges do
not meet in one task) and joined back; adaptive execution splits a hub's side of that join, as the
smallest neighbours are shuffled for it once more. Every round is written to the shared folder,
so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_marts.llm.shared import per_key, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """(u, v) both ways: larger neighbours v of u move to the smallest of u and its neighbours."""
    both = _both_ways(edges)
    least = per_key(both, ["a"], F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """(u, v) with v < u: u and its smaller neighbours move to the smallest of those."""
    least = per_key(edges, ["a"], F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(moved)


def components(edges: DataFrame) -> DataFrame:
    """Nodes (bigint) of edges (a, b) with ``component``, their component's smallest node.

    Nodes without an edge do not appear. Loops and repeated edges do no harm.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    stars = edges.where("a <> b").select(big.alias("a"), small.alias("b")).distinct()
    stars = written(stars, "components")
    state = None
    while True:
        stars = written(_small_star(_large_star(stars)).distinct(), "components")
        # Edges of settled stars repeat themselves; the sum of hashes tells sets apart.
        now = tuple(stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    centres = stars.select(F.col("b").alias("a"), "b").distinct()
    return stars.unionByName(centres).select(F.col("a").alias("node"), F.col("b").alias("component"))
