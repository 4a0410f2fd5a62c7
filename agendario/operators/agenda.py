"""Comparison of agendas with official sites: hours, line-ups, absences, corrections, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import sized


def hour_accuracy(agenda: DataFrame, official: DataFrame, keys: list[str], source: str, minutes: str, position: str) -> DataFrame:
    """Per source: comparisons with the first official time of the same keys, equal, earlier and later ones."""
    first = official.groupBy(*keys).agg(F.min_by(minutes, position).alias("official_"))
    met = agenda.where(F.col(minutes).isNotNull()).join(first, keys).where(F.col("official_").isNotNull())
    apart = F.col(minutes) - F.col("official_")
    return met.groupBy(source).agg(F.count("*").alias("n"), F.count_if(apart == 0).alias("same"), F.count_if(apart < 0).alias("earlier"), F.count_if(apart > 0).alias("later"))


def hours_by_accuracy(versions: DataFrame, keys: list[str], hour: str, source: str, rates: DataFrame, good: float = 0.65, bad: float = 0.55) -> DataFrame:
    """The hour of a conflict if exactly one version's best source is right in ``good`` of cases and all others' in ``bad`` at most."""
    per = versions.join(rates, source, "left").groupBy(*keys, hour).agg(F.max("rate").alias("rate"))
    out = per.groupBy(*keys).agg(
        F.count_if(F.col("rate") >= good).alias("good"),
        F.count_if(F.col("rate").isNotNull() & (F.col("rate") <= bad)).alias("bad"),
        F.count("*").alias("n"),
        F.max(F.when(F.col("rate") >= good, F.col(hour))).alias(hour),
    )
    return out.where("good = 1 AND bad = n - 1 AND n > 1").select(*keys, hour)


def line_up_conflicts(rows: DataFrame, keys: list[str], official: str, name: str) -> DataFrame:
    """Rows of equal keys (day, venue, hour) of which some are official and some not, with names the other side lacks."""
    sides = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.when(F.col(official), F.col(name)))).alias("theirs"), F.array_sort(F.collect_set(F.when(~F.col(official), F.col(name)))).alias("others")
    )
    return sides.where((F.size("theirs") > 0) & (F.size("others") > 0) & ~F.arrays_overlap("theirs", "others"))


def absences(rows: DataFrame, official: DataFrame, keys: list[str], day: str, published: DataFrame, venue: str) -> DataFrame:
    """Rows that a venue's own complete site lacks, within the time up to which it publishes."""
    covered = rows.join(published.select(venue, "until"), venue).where(F.col(day) <= F.col("until")).drop("until")
    return covered.join(official.select(*keys).distinct(), keys, "left_anti")


def apply_rules(rows: DataFrame, rules: DataFrame, day: str, optional: list[str]) -> DataFrame:
    """``rows`` with the action and note of the first rule (pos) of their day whose optional fields, where given, agree.

    A day's rules are one array, sent to the rows behind a check of their number; rows are not shuffled by it.
    """
    of_day = rules.groupBy(F.col(day).alias("rule_day")).agg(F.array_sort(F.collect_list(F.struct("pos", "action", "note", *[F.col(c).alias(f"rule_{c}") for c in optional]))).alias("rules_"))
    joined = rows.join(sized(of_day), rows[day] == F.col("rule_day"), "left")

    def agrees(rule: Column) -> Column:
        out = F.lit(True)
        for c in optional:
            out &= rule[f"rule_{c}"].isNull() | F.coalesce(rule[f"rule_{c}"] == F.col(c), F.lit(False))
        return out

    first = F.get(F.filter("rules_", agrees), F.lit(0))
    return joined.withColumns({"action": first["action"], "note": first["note"]}).drop("rule_day", "rules_")


def unmatched_rules(rows: DataFrame, rules: DataFrame, day: str, optional: list[str]) -> DataFrame:
    agree = rules[day] == rows[day]
    for c in optional:
        agree &= rules[c].isNull() | (rules[c] == rows[c])
    return rules.join(rows, agree, "left_anti")


def source_report(rows: DataFrame, previous: DataFrame, source: str, item: str) -> DataFrame:
    """Per source: its items, those that no other source has and those that the previous run had not."""
    pairs = rows.select(source, item).distinct()
    alone = pairs.groupBy(item).agg(F.count("*").alias("sources_"))
    seen = previous.select(item).distinct().withColumn("seen_", F.lit(True))
    full = pairs.join(alone, item).join(seen, item, "left")
    return full.groupBy(source).agg(F.count("*").alias("total"), F.count_if(F.col("sources_") == 1).alias("exclusive"), F.count_if(F.col("seen_").isNull()).alias("new"))


def movement(before: DataFrame, after: DataFrame, item: str, group: str) -> DataFrame:
    """Per group: items now, and those that entered and left it since the previous snapshot."""
    old = before.select(item, group).distinct().withColumn("was_", F.lit(True))
    new = after.select(item, group).distinct().withColumn("is_", F.lit(True))
    both = old.join(new, [item, group], "full_outer")
    return both.groupBy(group).agg(F.count("is_").alias("total"), F.count_if(F.col("was_").isNull()).alias("entered"), F.count_if(F.col("is_").isNull()).alias("left"))


def unconfirmed(rows: DataFrame, venue: str, official: Column, least: int = 4) -> DataFrame:
    """Venues with ``least`` rows or more and none of an official source, most first."""
    per = rows.groupBy(venue).agg(F.count("*").alias("n"), F.max(official.cast("int")).alias("official_"))
    return per.where((F.col("n") >= least) & (F.col("official_") == 0)).select(venue, "n").orderBy(F.desc("n"), venue)


def gaps(rows: DataFrame, owner: str, weight: Column, day: str, most: int) -> DataFrame:
    """Owners by what is missing: heaviest gap, then up to three rows, then earliest day; the ``most`` first."""
    per = rows.groupBy(owner).agg(F.max(weight).alias("weight"), F.least(F.count("*"), F.lit(3)).alias("bonus"), F.min(day).alias("first"))
    return per.orderBy(F.desc("weight"), F.desc("bonus"), "first", owner).limit(most)
