"""Conflict resolution: versions of a value, best priority, independent sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def resolve_by_priority(rows: DataFrame, keys: list[str], value: str, priority: str) -> DataFrame:
    """One row per key: n_versions, n_best, value and state.

    One version: it stands (``single``). Several: the only version of the best (lowest) priority
    stands (``resolved``), else the value is null (``conflict``). Null values are no versions.
    Both steps aggregate partially, so a key with very many rows is spread.
    """
    versions = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(priority).alias("best"))
    per = versions.groupBy(*keys).agg(
        F.count("*").alias("n_versions"),
        F.min(F.struct("best", value)).alias("first"),
        F.max(F.struct(-F.col("best"), F.col(value).alias("v"))).alias("last"),
    )
    tie = F.col(f"first.{value}") != F.col("last.v")
    state = F.when(F.col("n_versions") == 1, "single").when(tie, "conflict").otherwise("resolved")
    return per.select(*keys, "n_versions", F.when(state != "conflict", F.col(f"first.{value}")).alias("value"), state.alias("state"))


def independent_sources(rows: DataFrame, keys: list[str], group: str, least: int = 2) -> DataFrame:
    """Distinct independent groups per key, and whether they contrast the key."""
    n = rows.select(*keys, group).distinct().groupBy(*keys).agg(F.count(group).alias("n_groups"))
    return n.withColumn("state", F.when(F.col("n_groups") >= least, "contrasted").otherwise("one_source"))


def first_by_priority(rows: DataFrame, keys: list[str], columns: list[str], priority: str, position: str) -> DataFrame:
    """For each column the first value that is not null, by (priority, position)."""
    order = F.struct(F.col(priority), F.col(position))
    picks = [F.min(F.when(F.col(c).isNotNull(), F.struct(order.alias("o"), F.col(c).alias("v")))).getField("v").alias(c) for c in columns]
    return rows.groupBy(*keys).agg(*picks)


def best_spelling(rows: DataFrame, key: str, name: str) -> DataFrame:
    """The spelling of each key: not all capitals, then most frequent, then first by code point."""
    n = rows.groupBy(key, name).agg(F.count("*").alias("n"))
    calm = (F.upper(name) != F.col(name)).cast("int")
    ranked = n.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(calm.desc(), F.desc("n"), F.asc(name))))
    return ranked.where("rank = 1").select(key, F.col(name).alias("spelling"), "n")


def consensus(votes: DataFrame, keys: list[str], option: str, weight: str, share_of_best: float = 0.6, share_of_all: float = 0.25) -> DataFrame:
    """Options whose weight is near the best one's and a fair share of the total; a best tie of over two is no vote."""
    per = votes.groupBy(*keys, option).agg(F.sum(weight).alias("weight"))
    w = Window.partitionBy(*keys)
    best, total = F.max("weight").over(w), F.sum("weight").over(w)
    marked = per.select("*", best.alias("best"), total.alias("total")).withColumn("ties", F.count_if(F.col("weight") == F.col("best")).over(w))
    keep = F.when(F.col("weight") == F.col("best"), F.col("ties") <= 2).otherwise((F.col("weight") >= share_of_best * F.col("best")) & (F.col("weight") >= share_of_all * F.col("total")))
    return marked.where(keep).select(*keys, option, "weight")


def capped_weights(votes: DataFrame, keys: list[str], source: str, option: str, weight: str, cap: float) -> DataFrame:
    """Each source's greatest weight for an option, summed over sources up to ``cap``."""
    per = votes.groupBy(*keys, source, option).agg(F.max(weight).alias("w"))
    return per.groupBy(*keys, option).agg(F.least(F.sum("w"), F.lit(cap)).alias("weight"))


def ordered_rules(text, rules: list[tuple[str, str]]):
    """The label of the first rule (pattern, label) whose pattern is found; null if none."""
    out = F.lit(None).cast("string")
    for pattern, label in reversed(rules):
        out = F.when(text.rlike(pattern), F.lit(label)).otherwise(out)
    return out
