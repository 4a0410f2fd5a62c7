"""Profiles and scores of sources and records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """Half-even whole percentage; null for nothing."""
    return F.when(whole > 0, F.bround(100.0 * part / whole, 0).cast("int"))


def profile(rows: DataFrame, source: str, day: str, fields: list[str]) -> DataFrame:
    """Per source: rows, share of rows with each field, and share on the most repeated day."""
    per_day = rows.groupBy(source, day).agg(F.count("*").alias("n"), *[F.count(f).alias(f) for f in fields])
    per = per_day.groupBy(source).agg(F.sum("n").alias("n"), F.max("n").alias("top"), *[F.sum(f).alias(f) for f in fields])
    return per.select(source, "n", *[percent(F.col(f), F.col("n")).alias(f"pct_{f}") for f in fields], percent(F.col("top"), F.col("n")).alias("pct_same_day"))


def drift(before: DataFrame, after: DataFrame, source: str, field: str, high: int, low: int, least: int = 10) -> DataFrame:
    """Sources whose share of a field fell from ``high`` or more to ``low`` or less."""
    b, a = before.select(source, F.col(field).alias("was"), F.col("n").alias("n_was")), after.select(source, F.col(field).alias("now"), F.col("n").alias("n_now"))
    return b.join(a, source).where((F.col("n_was") >= least) & (F.col("n_now") >= least)).withColumn("drift", (F.col("was") >= high) & (F.col("now") <= low))


def usual_value(rows: DataFrame, place: str, weekday: str, value: str, least_place: int = 5, least_day: int = 3, share: float = 0.7) -> DataFrame:
    """The usual value of a place, and of a place on a weekday (null: any), where it is frequent enough."""
    n = rows.where(F.col(value).isNotNull()).groupingSets([[place, value], [place, weekday, value]], place, weekday, value).agg(F.count("*").alias("n"), F.grouping(weekday).alias("any_day"))
    w = Window.partitionBy(place, "any_day", weekday)
    ranked = n.select("*", F.sum("n").over(w).alias("total"), F.row_number().over(w.orderBy(F.desc("n"), F.asc(value))).alias("rank"))
    enough = F.col("total") >= F.when(F.col("any_day") == 1, least_place).otherwise(least_day)
    return ranked.where((F.col("rank") == 1) & enough & (F.col("n") >= share * F.col("total"))).select(place, weekday, F.col(value).alias("usual"), "n", "total")


def rolling_health(rows: DataFrame, source: str, day: str, days: int = 14) -> DataFrame:
    """Rows per source and day, and over the last ``days`` days."""
    n = rows.groupBy(source, day).agg(F.count("*").alias("n"))
    w = Window.partitionBy(source).orderBy(F.datediff(day, F.lit("1970-01-01").cast("date"))).rangeBetween(-(days - 1), 0)
    return n.select(source, day, "n", F.sum("n").over(w).alias("rolling"))


def shared_by_many(rows: DataFrame, item: str, owner: str, least: int) -> DataFrame:
    """Items (links, images) of at least ``least`` distinct owners: generic ones."""
    return rows.select(item, owner).distinct().groupBy(item).agg(F.count(owner).alias("owners")).where(F.col("owners") >= least)


def confidence(rows: DataFrame, keys: list[str], official: str, ticketing: str, group: str, conflict: str) -> DataFrame:
    """Points: official 4, ticketing 2, further independent groups up to 3, conflict -2; high from 4, medium from 2."""
    per = rows.groupBy(*keys).agg(F.max(official).alias("o"), F.max(ticketing).alias("t"), F.count_distinct(group).alias("g"), F.max(conflict).alias("c"))
    points = 4 * F.col("o").cast("int") + 2 * F.col("t").cast("int") + F.least(F.col("g") - 1, F.lit(3)) - 2 * F.col("c").cast("int")
    return per.select(*keys, points.cast("int").alias("points")).withColumn("level", F.when(F.col("points") >= 4, "high").when(F.col("points") >= 2, "medium").otherwise("low"))


def state_histogram(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(field, state, n) over several state columns, by unpivot."""
    return rows.unpivot([], fields, "field", "state").groupBy("field", "state").agg(F.count("*").alias("n"))
