"""Connected components by alternating star contractions.

Each round hooks every node's larger neighbours to its least neighbour and then its smaller ones;
the edges become stars after a number of rounds logarithmic in the largest component. A node of
many neighbours costs one row an edge, never a list; each round is cut off in the shared folder.
Rounds end when no edge changes, by count and by the sum of the edges' hashes; that they do not end
within the bound given is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.session import cut_lineage


def _least(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def components(edges: DataFrame, nodes: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): component is the least node of the component; nodes without an edge are their own."""
    e = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    for _ in range(rounds):
        # Large stars: each larger neighbour to the least of the node's neighbours and itself.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(e)
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small stars: each smaller neighbour, and the node, to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        e = cut_lineage(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not converge in {rounds} rounds")
    found = e.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.select("node").distinct().join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
