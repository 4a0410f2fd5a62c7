"""Connected components of an edge table, by repeated minimum labels (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import met, stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); root is the smallest node of its component.

    Alternates the two star operations until no edge changes; each round is linear in the edges and
    keeps no neighbour list. A node with very many edges is aggregated partially like any other, and
    its edges learn their least neighbour by broadcast (``shared.met``), so they stay spread.
    """
    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    n, before = now.count(), None
    for _ in range(most_rounds):
        # Large star: every larger neighbour of u is tied to the least node near u.
        back = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = now.unionByName(back).groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("k"))
        large = met(back, least, "u", n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        # Small star: u and its smaller neighbours are tied to the least of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k"))
        small = met(large, low, "u", n).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = stored(small.where(F.col("u") != F.col("v")).distinct(), "edges")
        sign = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if sign == before:
            break
        n, before = sign[0], sign
    else:
        raise RuntimeError("components did not settle")
    tied = now.groupBy("u").agg(F.min("v").alias("root"))
    # What has settled is a set of stars: a root is no one's larger node.
    roots = now.select(F.col("v").alias("node")).distinct()
    return tied.select(F.col("u").alias("node"), "root").unionByName(roots.select("node", F.col("node").alias("root")))
