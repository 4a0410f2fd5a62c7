"""Similarity joins of short texts, exact for their indel ratio (200 * LCS / lengths), without looking at all pairs.

Two texts of a ratio of ``least`` are at most d = (1 - least / 100) * (|a| + |b|) insertions and deletions apart, and each of these
touches at most q of a text's q-grams. So the two share one of their ``q * d + 1`` rarest q-grams (prefix filter): these meet in
an equi-join, with a bound on lengths, and only what is left is measured. The order is by frequency over all texts; equal
q-grams of one text are numbered (so their places say nothing). Texts that many blocks share are compared once. Texts too short for any difference meet by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import indel_ratio
from ..sources.tables import written


def _most(size: Column, least: float) -> Column:
    """How many insertions and deletions may lie between a text of this size and any other of the ratio."""
    e = 1 - least / 100
    return F.floor(e * (size + F.floor(size * (1 + e) / (1 - e) + 1e-9)) + 1e-9).cast("int")


def _grams(texts: DataFrame, block: list[str], least: float, q: int) -> DataFrame:
    """(block, s, size, gram): every numbered q-gram of the texts that may differ from one like them."""
    size = F.length("s")
    cut = F.transform(F.sequence(F.lit(1), size - q + 1), lambda i: F.substring("s", i, F.lit(q)))
    rows = texts.where((_most(size, least) > 0) & (size >= q)).select(*block, "s", size.alias("size"), cut.alias("cut"))
    numbered = F.transform("cut", lambda g, i: F.concat(g, F.lit("#"), F.size(F.filter(F.slice(F.col("cut"), 1, i), lambda x: x == g)).cast("string")))
    return rows.select(*block, "s", "size", F.explode(numbered).alias("gram"))


def _prefixes(texts: DataFrame, block: list[str], frequency: DataFrame, least: float, q: int) -> DataFrame:
    placed = _grams(texts, block, least, q).join(frequency, "gram")
    each = placed.groupBy(*block, "s", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    first = F.transform(F.slice("grams", F.lit(1), q * _most(F.col("size"), least) + 1), lambda g: g["gram"])
    return each.select(*block, "s", "size", first.alias("prefix")).select("*", F.explode("prefix").alias("gram"))


def alike(left: DataFrame, right: DataFrame, block: list[str], least: float = 90.0) -> DataFrame:
    """(block, a, b, ratio): the pairs of a text ``s`` of ``left`` and one of ``right`` in the same block of a ratio of ``least`` or more.

    Each text counts once per block; null and empty texts are left out. ``least`` is over 60.
    """
    if not 60 < least <= 100:
        raise ValueError("least must be over 60")
    q = 2 if least >= 90 else 1
    a, b = (df.select(*block, "s").where("s <> ''").distinct() for df in (left, right))
    if block:
        a = written(a, "left-texts")
        b = a if right is left else written(b, "right-texts")
        size = [df.agg(F.count("*"), F.count_distinct("s"), F.count_distinct(F.struct(*block))).first() for df in ((a,) if b is a else (a, b))]
        # Texts that come back in most blocks are compared once for all blocks, where that is less than in each of them.
        if size[0][1] * size[-1][1] * size[0][2] <= size[0][0] * size[-1][0]:
            pairs = alike(a.select("s"), b.select("s"), [], least)
            return a.withColumnRenamed("s", "a").join(pairs, "a").join(b.withColumnRenamed("s", "b"), [*block, "b"]).select(*block, "a", "b", "ratio")
    frequency = _grams(a.select("s").unionByName(b.select("s")), [], least, q).groupBy("gram").agg(F.count("*").alias("n"))
    # The grams' table is as small as the alphabet's powers; Spark broadcasts it where it is.
    x = _prefixes(a, block, frequency, least, q).withColumnsRenamed({"s": "a", "size": "a_size", "prefix": "a_prefix"})
    y = _prefixes(b, block, frequency, least, q).withColumnsRenamed({"s": "b", "size": "b_size", "prefix": "b_prefix"})
    far = (1 - least / 100) * (F.col("a_size") + F.col("b_size")) + 1e-9
    met = x.join(y, [*block, "gram"]).where((F.abs(F.col("a_size") - F.col("b_size")) <= far) & (F.col("a") != F.col("b")))
    # A pair is taken where it meets first: at the rarest gram of both prefixes, which are in one order.
    once = F.get(F.array_intersect("a_prefix", "b_prefix"), F.lit(0)) == F.col("gram")
    # A replacement counts two in an indel distance and one in Levenshtein's, which is banded and runs in the JVM.
    near = F.expr(f"levenshtein(a, b, CAST(floor({1 - least / 100!r}D * (a_size + b_size) + 1e-9D) AS INT)) >= 0")
    pairs = met.where(once & near).select(*block, "a", "b").withColumn("ratio", indel_ratio(F.col("a"), F.col("b"))).where(F.col("ratio") >= least)
    same = a.join(b, [*block, "s"], "left_semi").select(*block, F.col("s").alias("a"), F.col("s").alias("b"), F.lit(100.0).alias("ratio"))
    return pairs.unionByName(same)
