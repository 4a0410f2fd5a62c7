"""Lookups in ordered dictionaries: candidate cascades, longest suffixes, keyword rules, taxonomies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import let

#: A dictionary of at most so many rows is sent to all tasks; a larger one is joined by a shuffle.
SMALL = 50_000
#: So many keyword rules are tried one after the other.
FEW = 64


def sized(dictionary: DataFrame, most: int = SMALL) -> DataFrame:
    """The dictionary, marked for broadcast if it is small by count."""
    return F.broadcast(dictionary) if dictionary.limit(most + 1).count() <= most else dictionary


def first_hit(rows: DataFrame, key: str, candidates: str, dictionary: DataFrame, name: str, value: str) -> DataFrame:
    """(key, value) of the first of each key's ordered candidates that the dictionary has; null if none. One row per key, one scan."""
    known = sized(dictionary.select(F.col(name).alias("name_"), F.col(value).alias("value_")))
    tried = rows.select(key, F.posexplode_outer(candidates).alias("pos_", "name_")).join(known, "name_", "left")
    return tried.groupBy(key).agg(F.min_by("value_", F.when(F.col("value_").isNotNull(), F.col("pos_"))).alias(value))


def last_wins(entries: DataFrame, name: str, position: str) -> DataFrame:
    """One row per name: the one listed last, as when a dictionary is filled in order."""
    rank = F.row_number().over(Window.partitionBy(name).orderBy(F.desc(position)))
    return entries.withColumn("rank_", rank).where("rank_ = 1").drop("rank_")


def longest_suffix(rows: DataFrame, key: str, suffixes: str, dictionary: DataFrame, name: str, value: str) -> DataFrame:
    """(key, value) of the longest of each row's suffixes that the dictionary has; null if none."""
    known = sized(dictionary.select(F.col(name).alias("name_"), F.col(value).alias("value_")))
    tried = rows.select(key, F.explode_outer(suffixes).alias("name_")).join(known, "name_", "left")
    return tried.groupBy(key).agg(F.max_by("value_", F.when(F.col("value_").isNotNull(), F.length("name_"))).alias(value))


def first_keyword(rows: DataFrame, key: str, text: str, rules: DataFrame) -> DataFrame:
    """(key, label) of the first rule (pos, keyword, label) whose keyword the text has as whole words; null if none.

    The distinct words of a text, without the text, meet the keywords' first words in an equi-join; only the hits of
    longer keywords meet the text again and are looked for whole. At most ``FEW`` rules are tried in each text's own row
    instead, so that nothing is shuffled. ``key`` must be unique.
    """
    if rules.limit(FEW + 1).count() <= FEW:
        every = rules.where("pos IS NOT NULL").agg(F.array_sort(F.collect_list(F.struct("pos", "label", F.concat(F.lit(" "), "keyword", F.lit(" ")).alias("keyword")))).alias("rules_"))
        first = let(F.concat(F.lit(" "), text, F.lit(" ")), lambda t: F.get(F.filter("rules_", lambda r: F.contains(t, r["keyword"])), F.lit(0)))
        return rows.crossJoin(F.broadcast(every)).select(key, first["label"].alias("label"))
    words = rows.select(key, F.explode_outer(F.array_distinct(F.split(text, " "))).alias("w_"))
    known = sized(rules.select("pos", "label", "keyword", F.substring_index("keyword", " ", 1).alias("w_")))
    hits = words.join(known, "w_").select(key, "pos", "label", "keyword")
    whole = F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), "keyword", F.lit(" ")))
    long = hits.where(F.contains("keyword", F.lit(" "))).join(rows.select(key, text), key).where(whole).select(key, "pos", "label")
    none = rows.select(key, F.lit(None).cast("int").alias("pos"), F.lit(None).cast("string").alias("label"))
    every = hits.where(~F.contains("keyword", F.lit(" "))).select(key, "pos", "label").unionByName(long).unionByName(none)
    return every.groupBy(key).agg(F.min_by("label", "pos").alias("label"))


def inverted(taxonomy: DataFrame, genre: str, styles: str, position: str) -> DataFrame:
    """(style, genre) from (position, genre, styles): of several genres of a style the first stands."""
    flat = taxonomy.select(position, genre, F.explode(styles).alias("style"))
    return flat.groupBy("style").agg(F.min_by(genre, position).alias(genre))


def strong(votes: DataFrame, keys: list[str], option: str, count: str, share_of_best: float, most: int) -> DataFrame:
    """Options with a share of the best one's votes, the ``most`` first ones."""
    w = Window.partitionBy(*keys)
    ranked = votes.select("*", F.max(count).over(w).alias("best_"), F.row_number().over(w.orderBy(F.desc(count), F.asc(option))).alias("rank"))
    return ranked.where((F.col(count) >= share_of_best * F.col("best_")) & (F.col("rank") <= most)).drop("best_")
