"""Connected components of a large edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """edges(a, b) to (node, root): nodes share a root exactly if a path joins them. Nodes without an edge are not listed.

    In each round every node points to the neighbour, or itself, that comes first in a fresh random order; edges are redrawn
    between those and equal ones merged. The random order makes the rounds logarithmic for chains as well as for stars. Every
    round is written, so a lost executor repeats one round at most; a node's edges are combined before the shuffle.
    """
    left = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    labels, turn = None, 0
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.xxhash64(c, F.lit(turn)).alias("rank")  # noqa: E731, B023
        first = both.groupBy("a").agg(F.min(F.struct(rank("b"), F.col("b").alias("id"))).alias("first"))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("rank"), F.col("a").alias("id"))
        points = stored(first.select(F.col("a").alias("node"), F.least("first", own)["id"].alias("to")))
        moved = (
            left.join(points.select(F.col("node").alias("a"), F.col("to").alias("c")), "a")
            .join(points.select(F.col("node").alias("b"), F.col("to").alias("d")), "b")
            .where("c <> d")
        )
        left = stored(moved.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct())
        if labels is None:
            labels = points.select("node", F.col("to").alias("root"))
        else:
            step = points.select(F.col("node").alias("root"), "to")
            labels = stored(labels.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
        turn += 1
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
