"""Which pages to read within a budget, and whose reading of a field to trust.

Plans are cumulative sums: of a host's seconds in the order of need, and of all seconds over the whole plan. The latter is a
distributed prefix sum: sums per bucket of the order, running sums over the (few) buckets, and running sums inside each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written


def chosen_pages(pages: DataFrame, most: int = 3) -> DataFrame:
    """(record, url, host, n): the pages to read of each record, in order.

    ``pages`` has record, url, host, position (from 0), official and gaps (booleans). The first official page, else the first page; a record
    with gaps gets further pages of other hosts, ``most`` in all, each host's first.
    """
    best = F.min(F.struct((~F.col("official")).alias("other"), "position", "url", "host")).over(Window.partitionBy("record")).alias("best")
    rows = pages.select("*", best)
    first = rows.groupBy("record").agg(F.min("best").alias("b")).select("record", "b.url", "b.host", F.lit(0).alias("n"))
    rest = rows.where(F.col("gaps") & (F.col("host") != F.col("best.host"))).groupBy("record", "host").agg(F.min(F.struct("position", "url")).alias("p"))
    placed = rest.select("record", "p.url", "host", F.row_number().over(Window.partitionBy("record").orderBy("p.position", "p.url", "host")).alias("n")).where(F.col("n") < most)
    return first.unionByName(placed)


def schedule(wanted: DataFrame, seconds: Column, order: list[str], bucket: list[str], budget: float, quota: float) -> DataFrame:
    """``wanted`` (url, host and the order's columns) that fit, with ``starts``: the second of its host's time at which a page is read.

    A url counts once, at its first place. In that order a page is read if its host's seconds up to its end are within ``quota`` and all
    hosts' within ``budget``; what a host's quota leaves out costs nothing. ``bucket`` are the order's leading columns, of few values; ties of
    the order go by url.
    """
    once = wanted.withColumn("r_", F.row_number().over(Window.partitionBy("url").orderBy(*order, "host"))).where("r_ = 1").drop("r_").withColumn("cost_", seconds.cast("double"))
    host = Window.partitionBy("host").orderBy(*order, "url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = written(once.withColumn("ends_", F.sum("cost_").over(host)).where(F.col("ends_") <= quota), "within-quota")
    sums = within.groupBy(*bucket).agg(F.sum("cost_").alias("of_"))
    # One row per bucket: a window over all of them is small.
    before = F.coalesce(F.sum("of_").over(Window.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    offsets = sums.withColumn("before_", before).drop("of_")
    inner = Window.partitionBy(*bucket).orderBy(*order, "url").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = within.join(offsets, bucket).withColumn("all_", F.col("before_") + F.sum("cost_").over(inner))
    return told.where(F.col("all_") <= budget).withColumn("starts", F.col("ends_") - F.col("cost_")).drop("cost_", "ends_", "before_", "all_")


def trusted_readings(readings: DataFrame, trust: DataFrame, least: float = 0.0) -> DataFrame:
    """(record, field, value, host): of each record's readings of a field the one of the host most trusted for it.

    ``readings`` has record, field, value, host, position; ``trust`` has host, field, share. Unknown hosts have no share and come last;
    hosts below ``least`` aren't asked. Ties go by position, then value.
    """
    known = readings.where("value IS NOT NULL").join(trust.select("host", "field", "share"), ["host", "field"], "left")
    rank = F.struct(-F.coalesce("share", F.lit(-1.0)), F.col("position"), F.col("value"))
    best = known.where(F.col("share").isNull() | (F.col("share") >= least)).groupBy("record", "field").agg(F.min_by(F.struct("value", "host"), rank).alias("b"))
    return best.select("record", "field", "b.value", "b.host")
