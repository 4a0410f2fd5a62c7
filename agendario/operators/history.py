"""What has changed about a record from run to run, without what went back and forth.

Each run gives a snapshot of its records. Two snapshots of a record that follow each other give changes:

* ``always`` fields, whenever they differ,
* ``compared`` fields, where both values are known and both runs had the record from the same sources (else the difference is
  one between sources, not a change),
* ``once`` fields, when a new value is told,
* ``gone`` and ``back``, when the state becomes ``missing`` or stops being it.

A record's history is a fold over its changes in order: a change of an ``always`` or ``compared`` field that takes the last one of that field back
within ``within`` days removes it, ``back`` removes a ``gone`` of that time, a ``once`` value that is already there isn't told again, and after
each run the last ``most`` changes stay. ``history`` does this in the JVM over all runs; ``streaming.changes`` does it
run by run, with the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHANGES = "array<struct<day:date,field:string,was:string,now:string>>"


@dataclass(frozen=True)
class Watched:
    """Which columns of a snapshot are watched, and how."""

    key: str = "key"
    day: str = "day"
    sources: str = "sources"
    state: str = "state"
    missing: str = "possibly_cancelled"
    always: tuple[str, ...] = ()
    compared: tuple[str, ...] = ()
    once: tuple[str, ...] = ()
    within: int = 3
    most: int = 12


def run_changes(snapshots: DataFrame, w: Watched) -> DataFrame:
    """(key, day, changes) of each snapshot but a key's first, against the one before it. One snapshot per key and day."""
    fields = [*w.always, *w.compared, *w.once]
    now = F.struct(*[F.col(f).cast("string").alias(f) for f in fields], F.col(w.state).alias("state_"), F.array_sort(F.array_distinct(F.col(w.sources))).alias("sources_"))
    rows = snapshots.select(F.col(w.key).alias("key"), F.col(w.day).alias("day"), now.alias("now"))
    rows = rows.withColumn("was", F.lag("now").over(Window.partitionBy("key").orderBy("day"))).where("was IS NOT NULL")

    def change(when: Column, field: str, was: Column, after: Column) -> Column:
        return F.when(when, F.struct(F.col("day"), F.lit(field).alias("field"), was.cast("string").alias("was"), after.cast("string").alias("now")))

    def pair(f: str) -> tuple[Column, Column]:
        return F.col(f"was.{f}"), F.col(f"now.{f}")

    none, same = F.lit(None), F.col("was.sources_").eqNullSafe(F.col("now.sources_"))
    found = [change(~a.eqNullSafe(b), f, a, b) for f in w.always for a, b in [pair(f)]]
    found += [change(same & a.isNotNull() & b.isNotNull() & (a != b), f, a, b) for f in w.compared for a, b in [pair(f)]]
    found += [change(b.isNotNull() & ~a.eqNullSafe(b), f, none, b) for f in w.once for a, b in [pair(f)]]
    left, there = F.col("was.state_").eqNullSafe(F.lit(w.missing)), F.col("now.state_").eqNullSafe(F.lit(w.missing))
    found += [change(~left & there, "gone", none, none), change(left & ~there, "back", none, none)]
    return rows.select("key", "day", F.array_compact(F.array(*found)).cast(CHANGES).alias("changes")).where(F.size("changes") > 0)


def _add(w: Watched):
    def add(past: Column, h: Column) -> Column:
        look = F.when(h["field"] == "back", F.lit("gone")).otherwise(h["field"])
        at = F.array_max(F.filter(F.transform(past, lambda c, i: F.when(c["field"] == look, i)), lambda i: i.isNotNull()))
        last = F.get(past, at)
        recent = F.coalesce(F.datediff(h["day"], last["day"]) <= w.within, F.lit(False))
        turned = (h["field"] == "back") | (h["field"].isin(*w.always, *w.compared, "") & last["was"].eqNullSafe(h["now"]))
        told = h["field"].isin(*w.once, "") & F.exists(past, lambda c: (c["field"] == h["field"]) & c["now"].eqNullSafe(h["now"]))
        return F.when(recent & turned, F.filter(past, lambda c, i: i != at)).when(told, past).otherwise(F.concat(past, F.array(h))).cast(CHANGES)

    return add


def history(snapshots: DataFrame, w: Watched) -> DataFrame:
    """(key, changes): the history of each record that has one, after all runs."""
    runs = run_changes(snapshots, w).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("day", "changes"))).alias("runs"))

    def run(past: Column, r: Column) -> Column:
        grown = F.aggregate(r["changes"], past, _add(w))
        return F.get(F.transform(F.array(grown), lambda g: F.when(F.size(g) > w.most, F.slice(g, -w.most, w.most)).otherwise(g)), F.lit(0)).cast(CHANGES)

    folded = runs.select("key", F.aggregate("runs", F.array().cast(CHANGES), run).alias("changes"))
    return folded.where(F.size("changes") > 0)


def retained(records: DataFrame, day: str, today: Column, days: int = 31) -> DataFrame:
    """Records whose day isn't over ``days`` days past; those without a day stay."""
    return records.where(F.col(day).isNull() | (F.col(day) >= F.date_sub(today, days)))
