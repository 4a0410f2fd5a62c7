"""Weighted evidence about an artist's style, and states of a record's fields.

Votes are rows (keys, source, kind ``style`` or ``genre``, name, rank, weak); dictionaries are DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from . import lookup, resolve


def weighted(votes: DataFrame, weights: DataFrame, decay: float = 0.15, least: float = 0.4) -> DataFrame:
    """``votes`` with a weight: the source's (``weights``: source, kind, weight), less for each later rank."""
    share = F.greatest(F.lit(least), 1 - decay * F.coalesce("rank", F.lit(0)))
    return votes.join(lookup.sized(weights), ["source", "kind"]).withColumn("weight", F.col("weight") * share)


def without_implied(votes: DataFrame, keys: list[str], genre_of: DataFrame) -> DataFrame:
    """Votes without the genres that a style of the same keys implies (``genre_of``: style, genre)."""
    implied = votes.where("kind = 'style'").join(lookup.sized(genre_of), votes["name"] == genre_of["style"]).select(*keys, F.col("genre").alias("name"), F.lit("genre").alias("kind")).distinct()
    return votes.join(implied, [*keys, "name", "kind"], "left_anti")


def grouped_votes(votes: DataFrame, groups: DataFrame) -> DataFrame:
    """Votes with their group (``groups``: name, kind, group); names of several groups, or of none, do not vote."""
    clear = groups.groupBy("name", "kind").agg(F.min("group").alias("group"), F.count_distinct("group").alias("n")).where("n = 1").drop("n")
    return votes.join(lookup.sized(clear), ["name", "kind"])


def tallied(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Votes that count alike (same ``keys``, source, group, doubtful and weak) as one with their total weight.

    ``doubted`` and ``groups_by_evidence`` say the same of it, and need not hold a key's votes one by one.
    """
    alike = votes.withColumn("weak", F.coalesce("weak", F.lit(False))).groupBy(*keys, "source", "group", "doubtful", "weak").agg(F.sum("weight").alias("weight"))
    return written(alike, "votes")


def doubted(votes: DataFrame, keys: list[str]) -> DataFrame:
    """Votes in which a doubtful source's (``doubtful``) are weak where none of its groups has a vote of any other source.

    A source that was found by name alone may speak of a namesake.
    """
    sure = votes.where(~F.col("doubtful")).select(*keys, "group").distinct().withColumn("backed", F.lit(1))
    other = votes.where(~F.col("doubtful")).select(*keys).distinct().withColumn("others", F.lit(1))
    marked = votes.join(sure, [*keys, "group"], "left").join(other, keys, "left")
    w = Window.partitionBy(*keys, "source")
    contradicts = F.col("doubtful") & F.col("others").isNotNull() & (F.max(F.coalesce("backed", F.lit(0))).over(w) == 0)
    return marked.withColumn("weak", F.coalesce("weak", F.lit(False)) | F.coalesce(contradicts, F.lit(False))).drop("backed", "others")


def groups_by_evidence(votes: DataFrame, keys: list[str], context: DataFrame | None = None, weak_share: float = 0.5) -> DataFrame:
    """(keys, group, weight) by consensus; weak votes count for ``weak_share``.

    Keys with weak votes only keep the groups of their ``context`` (keys, group), where there is one.
    """
    w = F.col("weight") * F.when(F.coalesce("weak", F.lit(False)), weak_share).otherwise(1.0)
    counted = votes.withColumn("weight", w)
    if context is not None:
        strong = counted.groupBy(*keys).agg(F.max((~F.coalesce("weak", F.lit(False))).cast("int")).alias("strong_"))
        allowed = context.select(*keys, "group").distinct().withColumn("in_", F.lit(1))
        has = context.select(*keys).distinct().withColumn("has_", F.lit(1))
        counted = counted.join(strong, keys).join(allowed, [*keys, "group"], "left").join(has, keys, "left")
        counted = counted.where((F.col("strong_") == 1) | F.col("in_").isNotNull() | F.col("has_").isNull())
    return resolve.consensus(counted.select(*keys, "group", "weight"), keys, "group", "weight")


def groups_by_tags(tags: DataFrame, keys: list[str], groups: DataFrame, umbrella: tuple[str, ...]) -> DataFrame:
    """(keys, group, sources, umbrella) from the tags of agendas: umbrella groups only where nothing concrete is said."""
    said = tags.join(lookup.sized(groups), "tag").select(*keys, "group", "source").distinct().groupBy(*keys, "group").agg(F.count("*").alias("sources"))
    wide = F.col("group").isin(*umbrella)
    concrete = F.max((~wide).cast("int")).over(Window.partitionBy(*keys))
    return said.withColumns({"umbrella": wide, "concrete_": concrete}).where(~wide | (F.col("concrete_") == 0)).drop("concrete_")


def translated(tags: DataFrame, exact: DataFrame, families: list[tuple[str, str]]) -> DataFrame:
    """``tags`` with a group: by an exact entry (tag, group), else by the first family pattern that is found."""
    return tags.join(lookup.sized(exact), "tag", "left").withColumn("group", F.coalesce("group", resolve.ordered_rules(F.col("tag"), families)))


def line_up_groups(guests: DataFrame, keys: list[str], group: str, share: float = 0.5, most: int = 3) -> DataFrame:
    """The groups of a line-up: those with at least ``share`` of the most frequent one's artists, ``most`` at most."""
    n = guests.groupBy(*keys, group).agg(F.count("*").alias("n"))
    return lookup.strong(n, keys, group, "n", share, most)


def by_precedence(rows: DataFrame, columns: list[str], into: str) -> DataFrame:
    """``into`` is the first of the columns that is known, ``into_from`` its name."""
    known = [F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.lit(c).alias("from"))) for c in columns]
    return rows.withColumn("pick_", F.coalesce(*known)).withColumns({into: F.col("pick_.v"), f"{into}_from": F.col("pick_.from")}).drop("pick_")


def only_one(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value) where all known values of the keys agree."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias(value), F.count_distinct(value).alias("n_")).where("n_ = 1").drop("n_")


def contradictory(rows: DataFrame, keys: list[str], value: str, source: str, chosen: str) -> DataFrame:
    """(keys, value, sources) of the values of other sources that differ from the chosen one."""
    other = rows.where(F.col(value).isNotNull() & F.col(chosen).isNotNull() & (F.col(value) != F.col(chosen)))
    return other.groupBy(*keys, value).agg(F.count_distinct(source).alias("sources"))


# Fills


def fill(rows: DataFrame, given: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``rows`` whose null fields are filled from ``given`` (keys unique); ``filled`` lists the fields."""
    other = given.select(*keys, *[F.col(c).alias(f"given_{c}") for c in columns])
    joined = rows.join(other, keys, "left")
    filled = F.array_compact(F.array(*[F.when(F.col(c).isNull() & F.col(f"given_{c}").isNotNull(), c) for c in columns]))
    return joined.withColumn("filled", filled).withColumns({c: F.coalesce(c, f"given_{c}") for c in columns}).drop(*[f"given_{c}" for c in columns])


def estimate_hours(rows: DataFrame, usual: DataFrame, place: str, weekday: str, hour: str) -> DataFrame:
    """``rows`` with ``estimated``: where the hour is unknown, the usual one of place and weekday, else of the place.

    ``usual`` is the result of ``metrics.usual_value``: one row per place and weekday at most (null weekday: any).
    """
    of_day = usual.where(F.col(weekday).isNotNull()).select(place, weekday, F.col("usual").alias("of_day"))
    of_place = usual.where(F.col(weekday).isNull()).select(place, F.col("usual").alias("of_place"))
    joined = rows.join(lookup.sized(of_day), [place, weekday], "left").join(lookup.sized(of_place), place, "left")
    return joined.withColumn("estimated", F.when(F.col(hour).isNull(), F.coalesce("of_day", "of_place"))).drop("of_day", "of_place")


# States


def hour_state(hour: Column, conflict: Column, estimated: Column) -> Column:
    return F.when(conflict, "conflict").when(hour.isNotNull(), "known").when(estimated.isNotNull(), "estimated").otherwise("unknown")


def two_state(value: Column) -> Column:
    return F.when(value.isNotNull(), "known").otherwise("unknown")


def style_state(groups: Column, asked: Column, found: Column) -> Column:
    """``classified``, ``no_style`` (found, but without a style), ``not_found`` (asked in vain) or ``not_asked``."""
    return F.when(F.size(groups) > 0, "classified").when(found, "no_style").when(asked, "not_found").otherwise("not_asked")


def origin_state(country: Column, estimated: Column, contradictions: Column) -> Column:
    return F.when(country.isNotNull() & (contradictions > 0), "contradicted").when(country.isNotNull(), "known").when(estimated.isNotNull(), "estimated").otherwise("unknown")


# Tiers, sources, links


def tier(rows: DataFrame, venue_tiers: DataFrame, audience: Column, steps: tuple[tuple[int, int], ...]) -> DataFrame:
    """``rows`` with ``tier``: the greater of the venue's (``venue_tiers``: venue, tier) and the audience's; null if neither is known.

    ``steps`` are (least audience, tier), the greatest first.
    """
    of_audience = F.coalesce(*[F.when(audience >= least, F.lit(step)) for least, step in steps])
    joined = rows.join(lookup.sized(venue_tiers.select("venue", F.col("tier").alias("venue_tier"))), "venue", "left")
    return joined.withColumn("tier", F.greatest("venue_tier", of_audience)).drop("venue_tier")


def frozen_sources(reads: DataFrame, source: str, day: str, ok: str, today: Column, days: int = 2) -> DataFrame:
    """(source, last): sources whose last good read is over ``days`` days past."""
    last = reads.groupBy(source).agg(F.max(F.when(F.col(ok), F.col(day))).alias("last"))
    return last.where(F.col("last").isNull() | (F.col("last") < F.date_sub(today, days)))


def mark_frozen(rows: DataFrame, key: str, source: str, frozen: DataFrame, today: Column, hide: int = 30) -> DataFrame:
    """(key, frozen, hidden): all sources of a record are frozen; hidden when the freshest of them is over ``hide`` days old."""
    marked = rows.select(key, source).distinct().join(lookup.sized(frozen.select(source, "last", F.lit(True).alias("is_"))), source, "left")
    per = marked.groupBy(key).agg(F.min(F.coalesce("is_", F.lit(False)).cast("int")).alias("all_"), F.max("last").alias("last_"))
    stopped = F.col("all_") == 1
    return per.select(key, stopped.alias("frozen"), (stopped & F.coalesce(F.col("last_") < F.date_sub(today, hide), F.lit(True))).alias("hidden"))


def failing_streak(reads: DataFrame, source: str, day: str, ok: str) -> DataFrame:
    """(source, streak): failed reads since the last good one."""
    last = F.max(F.when(F.col(ok), F.col(day))).over(Window.partitionBy(source))
    since = reads.withColumn("last_", last).withColumn("fails_", ~F.col(ok) & (F.col("last_").isNull() | (F.col(day) > F.col("last_"))))
    return since.groupBy(source).agg(F.count_if("fails_").alias("streak"))


def trusted_domains(comparisons: DataFrame, domain: str, field: str, agree: str, least: int = 3, share: float = 0.8) -> DataFrame:
    """(domain, field, n, same) of the fields in which a domain's pages agree with the records often enough."""
    n = comparisons.groupBy(domain, field).agg(F.count("*").alias("n"), F.count_if(agree).alias("same"))
    return n.where((F.col("n") >= least) & (F.col("same") >= share * F.col("n")))


def own_pages(links: DataFrame, record: str, url: str, priority: str, most: int = 4) -> DataFrame:
    """(record, url, rank): pages that one record alone links to, one per host, by priority; ``most`` of them are the feature."""
    from ..functions.text import url_domain

    once = links.select(record, url, priority).groupBy(record, url).agg(F.min(priority).alias(priority))
    alone = once.withColumn("uses_", F.count("*").over(Window.partitionBy(url))).where("uses_ = 1")
    per_host = alone.withColumn("host_", F.row_number().over(Window.partitionBy(record, url_domain(F.col(url))).orderBy(priority, url))).where("host_ = 1")
    return per_host.withColumn("rank", F.row_number().over(Window.partitionBy(record).orderBy(priority, url))).where(F.col("rank") <= most).select(record, url, "rank")


def shared_titles(rows: DataFrame, keys: list[str], title: str, reference: DataFrame, least: int = 2) -> DataFrame:
    """(keys, candidate, shared): the one candidate that shares ``least`` titles or more with the reference list of its keys."""
    met = rows.select(*keys, "candidate", title).distinct().join(reference.select(*keys, title).distinct(), [*keys, title])
    n = met.groupBy(*keys, "candidate").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    return n.withColumn("n_", F.count("*").over(Window.partitionBy(*keys))).where("n_ = 1").drop("n_")


def latest(rows: DataFrame, keys: list[str], day: str, kind: str, order: tuple[str, ...]) -> DataFrame:
    """The latest row of the best kind of each key."""
    best = F.array_position(F.array(*map(F.lit, order)), F.col(kind))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(best, F.desc(day)))
    return rows.where(best > 0).withColumn("rank_", rank).where("rank_ = 1").drop("rank_")


def reading_queue(rows: DataFrame, cache: DataFrame, key: str, gap: Column, day: str, today: Column, near: int = 3, far: int = 10, ahead: int = 14) -> DataFrame:
    """Pages to read again: never read, or older than ``near`` days for events within ``ahead`` days, else than ``far``; gaps first, then day."""
    age = F.datediff(today, F.col("read_on"))
    due = F.col("read_on").isNull() | (age > F.when(F.datediff(F.col(day), today) <= ahead, near).otherwise(far))
    found = rows.withColumn("gap", gap).join(cache.select(key, "read_on"), key, "left").where((F.col(day) >= today) & due)
    return found.orderBy(F.desc("gap"), day, key)


def alias_pairs(names: DataFrame, key: str, least: float = 88.0) -> DataFrame:
    """All pairs of names (keys) whose sorted words are alike by a ratio of ``least``: a report of likely aliases.

    Exact: candidates come from the prefix filter of ``simjoin``. Names of the same words in another order are pairs, too.
    """
    from ..functions import similarity
    from .simjoin import alike

    known = names.select(key).where(F.col(key) != "").distinct().select(key, similarity.token_sort(F.col(key)).alias("s"))
    pairs = alike(known, known, [], least)
    left, right = known.withColumnRenamed("s", "a"), known.select(F.col(key).alias("other"), F.col("s").alias("b"))
    return pairs.join(left, "a").join(right, "b").where(F.col(key) < F.col("other")).select(key, "other", "ratio")
