"""One table of events out of many listings: scope, clean, cluster, resolve, merge venues, reconcile.

``listings`` have row_id (unique), day, name, guests (array), venue, city, minutes, price, url, source; ``sources`` have source,
priority (1 is best), grp (the unit of independence) and town (where its listings are, if it never says).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fields import has_broken_encoding, is_filler, place_candidates
from ..functions.text import norm_key
from ..sources.tables import written
from . import cluster, lookup, resolve, temporal
from .matching import Rules, like_flexible


def towns_of(rows: DataFrame, key: str, place: str, towns: DataFrame) -> DataFrame:
    """(key, town) of each row by the first part of its place that is a town or an alias (``towns``: alias key, town)."""
    tried = rows.select(key, place_candidates(F.col(place)).alias("tried_"))
    return lookup.first_hit(tried, key, "tried_", towns, "alias", "town")


def prepare(listings: DataFrame, sources: DataFrame, towns: DataFrame, venues: DataFrame, first: Column, last: Column, filler: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows in scope, rejected per reason and source).

    In scope: a name that names someone, a day in the window, a town. The town is the city's, null if the city is given
    but unknown; else the venue's (``venues``: venue key, town), else the source's. Rows with a broken encoding go where a clean row of
    the same day and venue exists. Venues get the most usual spelling of their key.
    """
    small = lookup.sized(sources.withColumnRenamed("town", "source_town"))
    keyed = listings.join(small, "source").withColumn("venue_key", norm_key(F.coalesce("venue", F.lit(""))))
    inside = (F.col("day") >= first) & (F.col("day") <= last)
    early = F.when(F.coalesce(is_filler(F.col("name"), filler), F.lit(True)), "no name").when(~F.coalesce(inside, F.lit(False)), "day")
    given = F.coalesce("city", F.lit("")) != ""

    def cities(rows: DataFrame) -> DataFrame:
        """Each different city is looked up once, whatever the number of rows that name it."""
        return towns_of(rows.where(given).select("city").distinct(), "city", "city", towns).withColumnRenamed("town", "city_town")

    def placed(rows: DataFrame, known: DataFrame) -> DataFrame:
        rows = rows.join(known, "city", "left").join(lookup.sized(venues.select("venue_key", F.col("town").alias("venue_town"))), "venue_key", "left")
        unknown = given & F.col("city_town").isNull()
        return rows.withColumn("town", F.when(~unknown, F.coalesce("venue_town", "city_town", "source_town"))).drop("source_town", "city_town", "venue_town")

    broken = F.coalesce(has_broken_encoding(F.concat_ws(" ", "name", "venue")), F.lit(False))
    # Only what is in scope is written; the rest is counted, by what its town hangs on, where somebody asks for it.
    known = lookup.sized(written(cities(listings.where(inside)), "cities"))
    likely = written(placed(keyed.where(inside).where(early.isNull()), known).where("town IS NOT NULL").withColumn("broken", broken), "in-scope")
    told = keyed.select("source", "source_town", early.alias("reason"), "city", "venue_key")
    told = told.withColumns({c: F.when(F.col("reason").isNull(), F.col(c)) for c in ("city", "venue_key")}).groupBy(*told.columns).agg(F.count("*").alias("n"))
    out = placed(told, cities(told)).withColumn("reason", F.when(F.col("reason").isNull() & F.col("town").isNull(), "town").otherwise(F.col("reason")))
    cleaner = likely.where("NOT broken").select("day", "town").distinct().withColumn("clean", F.lit(True))
    likely = likely.join(cleaner, ["day", "town"], "left").withColumn("worse", F.col("broken") & F.coalesce("clean", F.lit(False))).drop("broken", "clean")
    kept = likely.where("NOT worse").drop("worse")
    spelling = resolve.best_spelling(kept.where("venue_key <> ''"), "venue_key", "venue").select("venue_key", "spelling")
    kept = kept.join(spelling, "venue_key", "left").withColumn("venue", F.coalesce("spelling", "venue")).drop("spelling")
    rejected = out.where(F.col("reason").isNotNull()).select("source", "reason", "n").unionByName(likely.where("worse").select("source", F.lit("encoding").alias("reason"), F.lit(1).cast("long").alias("n")))
    return kept, rejected.groupBy("source", "reason").agg(F.sum("n").alias("n"))


def records(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One record per cluster of ``prepare``'s rows: event_id, day, artist, guests, venue, minutes, price, sources, state and conflicts.

    The headliner and the price are the first by priority. Venue and hour: the only version of the best priority stands;
    where several tie, the value is null and the field is listed in ``conflicts`` with its versions.
    """
    billed = F.concat(F.array("name"), F.coalesce("guests", F.array().cast("array<string>")))
    given = [c for c in cluster.OPTIONAL if c in rows.columns]
    ids = written(cluster.clusters(rows.select("day", "row_id", billed.alias("names"), "venue", "priority", "minutes", *given), ["day"], rules), "clusters")
    rank = F.struct("priority", "row_id")

    def first(c: str) -> Column:
        return F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c)

    def versions(c: Column, name: str) -> Column:
        return F.collect_set(F.when(c.isNotNull(), F.struct(F.col("priority"), c.alias("said")))).alias(name)

    people = F.array_distinct(F.flatten(F.collect_set(F.filter(F.transform(billed, lambda n: F.struct(norm_key(n).alias("who_key"), n.alias("who"))), lambda p: p["who_key"] != ""))))
    held = rows.join(ids, "row_id").groupBy("cluster_id").agg(
        first("name"), first("price"), first("url"), first("day"), versions(F.nullif("venue", F.lit("")), "venues"), versions(F.col("minutes"), "hours"), F.count_distinct("grp").alias("n_groups"),
        F.array_sort(people).alias("people"), F.array_sort(F.collect_set(F.struct("priority", "source", "url"))).alias("sources"),
    )

    def best(found: str) -> Column:
        """The different versions of the best priority that has one."""
        return F.array_distinct(F.transform(F.filter(found, lambda x: x["priority"] == F.array_min(F.transform(found, lambda y: y["priority"]))), lambda x: x["said"]))

    out = held.withColumns({"venue": best("venues"), "minutes": best("hours")})
    conflicts = F.array_compact(F.array(F.when(F.size("venue") > 1, "venue"), F.when(F.size("minutes") > 1, "hour")))
    out = out.withColumns({"conflicts": conflicts, "venue": F.when(F.size("venue") == 1, F.get("venue", F.lit(0))), "minutes": F.when(F.size("minutes") == 1, F.get("minutes", F.lit(0)))})
    # People are in order of key and name: of one key the first spelling stays.
    once = F.filter("people", lambda p, i: (i == 0) | (F.get(F.col("people"), i - 1)["who_key"] != p["who_key"]))
    guests = F.transform(F.filter(once, lambda p: p["who_key"] != norm_key(F.col("name"))), lambda p: p["who"])
    state = F.when(F.size("conflicts") > 0, "conflict").when(F.col("n_groups") >= 2, "contrasted").otherwise("one_source")
    return out.select(F.col("cluster_id").alias("event_id"), "day", F.col("name").alias("artist"), guests.alias("guests"), "venue", "minutes", "price", "sources", "conflicts", state.alias("state"))


def merge_venues(events: DataFrame) -> DataFrame:
    """Events of one day and artist at several venues become one, unless a source announces two of them.

    The best source's event stays; it is in conflict about its venue if another has the same priority.
    """
    best = F.get("sources", F.lit(0))["priority"]
    keyed = events.withColumns({"who": norm_key(F.col("artist")), "best": best, "where": norm_key(F.coalesce("venue", F.lit("")))})
    said = keyed.select("day", "who", "event_id", F.explode(F.array_distinct(F.transform("sources", lambda s: s["source"]))).alias("source"))
    twice = said.groupBy("day", "who", "source").agg(F.count("*").alias("n")).where("n > 1").select("day", "who").distinct()
    per = keyed.where("where <> '' AND who <> ''").groupBy("day", "who").agg(F.count_distinct("where").alias("venues"), F.min(F.struct("best", "event_id")).alias("first"), F.count("*").alias("k"))
    several = per.where("venues > 1").join(twice, ["day", "who"], "left_anti")
    tie = keyed.join(several.select("day", "who", "first"), ["day", "who"]).groupBy("day", "who").agg((F.count_if(F.col("best") == F.col("first.best")) > 1).alias("tie"))
    marked = keyed.join(several.join(tie, ["day", "who"]).select("day", "who", F.col("first.event_id").alias("into"), "tie"), ["day", "who"], "left")
    stays = F.col("into").isNull() | (F.col("into") == F.col("event_id")) | (F.col("where") == "")
    conflict = F.coalesce("tie", F.lit(False)) & (F.col("where") != "")
    out = marked.where(stays)
    return out.withColumns({
        "venue": F.when(~conflict, F.col("venue")),
        "conflicts": F.when(conflict, F.array_union("conflicts", F.array(F.lit("venue")))).otherwise(F.col("conflicts")),
        "state": F.when(conflict, "conflict").otherwise(F.col("state")),
    }).select(*events.columns)


def _alike(pairs: DataFrame, rules: Rules) -> DataFrame:
    """The pairs whose names (keys a and b) are alike, in Arrow batches."""

    @F.pandas_udf("boolean")
    def test(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([like_flexible(x, y, rules) for x, y in zip(a, b)], dtype=bool)

    return pairs.where(test("a", "b"))


def reconcile(current: DataFrame, previous: DataFrame, complete: DataFrame, today: Column, rules: Rules = Rules(), days: int = 30) -> DataFrame:
    """State of every event of this run and the one before: id, old_id and state.

    First pass: equal day, venue and artist. Second: of what is left, equal day and venue and alike names, where the pair is the
    only one of both sides. Then a day moved: equal venue and artist at most ``days`` apart, unique both ways. Of the rest,
    current events are ``new``; previous ones are ``past``, ``possibly_cancelled`` if all their sources were read whole
    (``complete``: source, complete), else ``carried``. Both tables have event_id, day, artist, venue, sources.
    """

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("event_id").alias(name), "day", norm_key(F.col("artist")).alias("who"), norm_key(F.coalesce("venue", F.lit(""))).alias("where"))

    now, was = written(keyed(current, "id"), "now"), written(keyed(previous, "old_id"), "was")
    strict = now.join(was, ["day", "who", "where"]).groupBy("id").agg(F.min("old_id").alias("old_id")).groupBy("old_id").agg(F.min("id").alias("id"))
    strict = written(strict.select("id", "old_id", F.lit("kept").alias("state")), "strict")

    def left(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        return now.join(pairs.select("id"), "id", "left_anti"), was.join(pairs.select("old_id"), "old_id", "left_anti")

    a, b = left(strict)
    near = a.select("id", "day", "where", F.col("who").alias("a")).join(b.select("old_id", "day", "where", F.col("who").alias("b")), ["day", "where"])
    renamed = written(temporal.unique_pairs(_alike(near.where("where <> ''"), rules), "id", "old_id").select("id", "old_id", F.lit("renamed").alias("state")), "renamed")
    both = strict.unionByName(renamed)
    a, b = left(both)
    moved = temporal.within_days(a.where("where <> '' AND who <> ''"), b, ["who", "where"], "day", days)
    moved = temporal.unique_pairs(moved.select("id", F.col("r_old_id").alias("old_id")), "id", "old_id").select("id", "old_id", F.lit("moved").alias("state"))
    both = written(both.unionByName(moved), "matched")
    a, b = left(both)
    whole = previous.select(F.col("event_id").alias("old_id"), F.explode(F.array_distinct(F.transform("sources", lambda s: s["source"]))).alias("source"))
    whole = whole.join(lookup.sized(complete), "source", "left").groupBy("old_id").agg(F.min(F.coalesce("complete", F.lit(False)).cast("int")).alias("whole"))
    gone = b.join(whole, "old_id", "left").select(
        F.lit(None).cast("long").alias("id"), "old_id", F.when(F.col("day") < today, "past").when(F.col("whole") == 1, "possibly_cancelled").otherwise("carried").alias("state")
    )
    return both.unionByName(a.select("id", F.lit(None).cast("long").alias("old_id"), F.lit("new").alias("state"))).unionByName(gone)


def consolidated(listings: DataFrame, sources: DataFrame, towns: DataFrame, venues: DataFrame, first: Column, last: Column, filler: tuple[str, ...] = (), rules: Rules = Rules()) -> DataFrame:
    """``prepare``, ``records`` and ``merge_venues`` in a row."""
    kept, _ = prepare(listings, sources, towns, venues, first, last, filler)
    return merge_venues(records(kept, rules))
