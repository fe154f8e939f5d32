"""Connected components of a graph of links, without collecting any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.session import settle


def _pairs(one: DataFrame, other: DataFrame | None = None) -> DataFrame:
    both = one if other is None else one.unionByName(other)
    return both.where(F.col("high") != F.col("low")).distinct()


def connected(links: DataFrame, a: str, b: str) -> DataFrame:
    """One row (node, root) per node that has a link to another node; ``root`` is the smallest node
    reachable.  NULL ends and links of a node to itself are left out; repeated links count once.

    Rounds of two rewritings, large star and small star, which hang the larger neighbours and then
    the smaller ones of every node below the smallest of them, until nothing moves: the rows that
    need it are of the order of the links, the rounds of the order of the logarithm of the nodes.
    Each round is stored, so a lost executor costs that round at most.
    """
    stored = settle(
        _pairs(links.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
            F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
        )),
        "links",
    )

    def mark(frame: DataFrame):
        return frame.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first()

    before = mark(stored)
    while before[0]:
        # Large star: every larger neighbour of a node moves to the smallest of node and neighbours.
        both = stored.select(F.col("high").alias("node"), F.col("low").alias("near")).unionByName(
            stored.select(F.col("low").alias("node"), F.col("high").alias("near"))
        )
        # Stored so that both sides of the join are plain shuffles; AQE can then split a hot node.
        least = settle(both.groupBy("node").agg(F.min("near").alias("least")), "least")
        larger = both.where(F.col("near") > F.col("node")).join(least, "node")
        large = settle(
            _pairs(larger.select(F.col("near").alias("high"), F.least("node", "least").alias("low"))), "large-star"
        )
        # Small star: every smaller neighbour of a node, and the node, move to the smallest of them.
        lowest = settle(large.groupBy("high").agg(F.min("low").alias("least")), "lowest")
        moved = large.join(lowest, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        stored = settle(_pairs(moved, lowest.select("high", F.col("least").alias("low"))), "small-star")
        after = mark(stored)
        if after == before:
            break
        before = after
    return stored.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        stored.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
