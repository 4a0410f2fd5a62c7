"""Range, nearest and unique-pair joins on dates, by equi-keys on buckets of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def within_days(left: DataFrame, right: DataFrame, keys: list[str], day: str, days: int) -> DataFrame:
    """Pairs of equal keys at most ``days`` apart: left columns, and the right ones prefixed ``r_``.

    Days are dealt into buckets of ``days`` + 1, so the join is an equi-join on (keys, bucket) and a
    key with many rows meets only rows of neighbouring buckets.
    """
    width = days + 1
    bucket = F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / width)
    l = left.withColumn("bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))  # noqa: E741
    r = right.withColumn("bucket", bucket).select(*[F.col(c).alias(f"r_{c}") for c in [*right.columns, "bucket"]])
    on = [F.col(k) == F.col(f"r_{k}") for k in keys] + [F.col("bucket") == F.col("r_bucket")]
    return l.join(r, on).where(F.abs(F.datediff(f"r_{day}", day)) <= days).drop("bucket", "r_bucket")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], day: str) -> DataFrame:
    """Each left row with the nearest right day of the same keys (the earlier on a tie; null if none).

    Right days are merged into the left rows' order and filled forwards and backwards: one shuffle,
    no pairs.
    """
    l = left.select(*left.columns, F.lit(None).cast("date").alias("other"))  # noqa: E741
    r = right.select(*[F.col(c) if c in [*keys, day] else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns], F.col(day).alias("other"))
    both = l.withColumn("side", F.lit(1)).unionByName(r.withColumn("side", F.lit(0)))
    order = Window.partitionBy(*keys).orderBy(day, "side")
    before = F.last("other", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.first("other", ignorenulls=True).over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    found = both.select("*", before.alias("before"), after.alias("after")).where("side = 1")
    closer = F.coalesce(F.datediff(day, "before") <= F.datediff("after", day), F.col("after").isNull())
    return found.withColumn("nearest", F.when(closer, F.col("before")).otherwise(F.col("after"))).drop("other", "side", "before", "after")


def unique_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs that are the only one of either side."""
    n_a, n_b = (F.count("*").over(Window.partitionBy(c)) for c in (a, b))
    return pairs.select("*", n_a.alias("n_a"), n_b.alias("n_b")).where("n_a = 1 AND n_b = 1").drop("n_a", "n_b")


def every_night(rows: DataFrame, start: str, end: str, most: int) -> DataFrame:
    """One row per night of a run of days, ``most`` at most."""
    last = F.least(F.col(end), F.date_add(start, most - 1))
    return rows.withColumn("night", F.explode(F.sequence(F.col(start), F.greatest(last, F.col(start)))))


def horizon_band(day: Column, today: Column, bands: tuple[int, ...] = (120, 150, 180, 240, 365)) -> Column:
    ahead, out = F.datediff(day, today), F.lit(f">{bands[-1]}")
    for band in reversed(bands):
        out = F.when(ahead <= band, F.lit(f"<={band}")).otherwise(out)
    return out
