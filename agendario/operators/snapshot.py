"""Snapshots: cache completion, change capture, reconciliation, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def complete_with_cache(fresh: DataFrame, cached: DataFrame, keys: list[str]) -> DataFrame:
    """``fresh`` and those cached rows whose key it lacks, marked in ``from_cache``."""
    missing = cached.join(fresh.select(*keys).distinct(), keys, "left_anti")
    return fresh.withColumn("from_cache", F.lit(False)).unionByName(missing.withColumn("from_cache", F.lit(True)))


def changes(before: DataFrame, after: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Change data capture: one row per key and changed field, or per key that appeared or vanished."""
    old = before.select(F.col(key).alias("k"), F.struct(*fields).alias("old"))
    new = after.select(F.col(key).alias("k"), F.struct(*fields).alias("new"))
    both = old.join(new, "k", "full_outer")
    text = {f: (F.col(f"old.{f}").cast("string"), F.col(f"new.{f}").cast("string")) for f in fields}
    each = [F.when(~a.eqNullSafe(b), F.struct(F.lit(f).alias("field"), a.alias("was"), b.alias("now"))) for f, (a, b) in text.items()]
    none = F.lit(None).cast("string")
    kind = F.when(F.col("old").isNull(), F.lit("new")).when(F.col("new").isNull(), F.lit("gone"))
    whole = F.array(F.struct(kind.alias("field"), none.alias("was"), none.alias("now")))
    found = F.when(kind.isNotNull(), whole).otherwise(F.filter(F.array(*each), lambda x: x.isNotNull()))
    return both.select(F.col("k").alias(key), F.explode(found).alias("c")).select(key, "c.field", "c.was", "c.now")


def reconcile(current: DataFrame, previous: DataFrame, key: str, source: str, complete: DataFrame) -> DataFrame:
    """State of every key: ``kept``, ``new``, ``possibly_cancelled`` (absent though its source was read whole) or ``carried``."""
    now = current.select(key).distinct().withColumn("in_now", F.lit(True))
    was = previous.groupBy(key).agg(F.min(source).alias("was_source"))
    whole = complete.select(F.col(source).alias("was_source"), "complete")
    state = (
        F.when(F.col("in_now") & F.col("was_source").isNotNull(), "kept").when(F.col("in_now"), "new")
        .when(F.coalesce("complete", F.lit(False)), "possibly_cancelled").otherwise("carried")
    )
    return was.join(now, key, "full_outer").join(whole, "was_source", "left").select(key, state.alias("state"))


def newest_of(ours: DataFrame, theirs: DataFrame, key: str, stamp: str) -> DataFrame:
    """Union of two keyed caches: the newest row of a key, ours on a tie."""
    both = ours.withColumn("ours", F.lit(1)).unionByName(theirs.withColumn("ours", F.lit(0)))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(stamp), F.desc("ours")))
    return both.withColumn("rank", rank).where("rank = 1").drop("rank")


def copies_to_keep(copies: DataFrame, day: str, today: Column, days: int = 7, weeks: int = 5) -> DataFrame:
    """The copies of the last ``days`` days, and the first of each of the last ``weeks`` ISO weeks."""
    recent = copies.where(F.col(day) > F.date_sub(today, days)).select(day)
    monday = F.date_trunc("week", day).cast("date")
    first = copies.groupBy(monday.alias("week")).agg(F.min(day).alias(day)).where(F.col("week") > F.date_sub(F.date_trunc("week", today).cast("date"), 7 * weeks)).select(day)
    return recent.union(first).distinct()


def stale(cache: DataFrame, stamp: str, today: Column, days: int) -> DataFrame:
    return cache.where(F.col(stamp).isNull() | (F.datediff(today, stamp) > days))
