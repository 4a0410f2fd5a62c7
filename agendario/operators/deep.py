"""Nested values (VARIANT) merged path by path, and upserts with a report.

A value is taken apart into its leaves (scalars, lists, empty objects; a list is one leaf), leaves of both sides meet on
(key, path), a rule decides each of them, and what is left is put together again from the deepest level up. All are joins and
aggregations; the number of steps is that of levels, which no limit bounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.jsonwalk import STEPS, part
from ..sources.tables import written


def _members(v: Column) -> Column:
    return part(v, "$", "map<string,variant>")


def leaves(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(``key``, path, v): the leaves of each value; ``path`` is the array of member names. A null value has none; JSON null is a leaf."""
    return _leaves(rows, [key], value)


def _leaves(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    level = rows.select(*keys, F.array().cast("array<string>").alias("path"), F.col(value).alias("v")).where("v IS NOT NULL")
    while True:
        for _ in range(STEPS):
            inner = F.transform(F.map_entries(_members(F.col("v"))), lambda e: F.struct(F.array(e["key"]).alias("name"), e["value"].alias("v")))
            itself = F.array(F.struct(F.array().cast("array<string>").alias("name"), F.col("v").alias("v")))
            opened = F.when(F.size(_members(F.col("v"))) > 0, inner).otherwise(itself)
            level = level.select(*keys, "path", F.explode(opened).alias("c")).select(*keys, F.concat("path", "c.name").alias("path"), F.col("c.v").alias("v"))
        level = written(level, "leaves")
        if not level.where(F.size(_members(F.col("v"))) > 0).take(1):
            return level


def together(found: DataFrame, key: str) -> DataFrame:
    """(``key``, v): values put together from their leaves (``key``, path, v). No path may begin with another one of its key."""
    level = written(found.select(key, "path", "v"), "level")
    while True:
        depth = level.agg(F.max(F.size("path"))).first()[0]
        if not depth:
            return level.select(key, "v")
        deepest = level.where(F.size("path") == depth)
        above = F.slice("path", F.lit(1), F.size("path") - 1)
        joined = deepest.groupBy(key, above.alias("path")).agg(F.map_from_entries(F.collect_list(F.struct(F.element_at("path", -1).alias("name"), "v"))).alias("m"))
        level = written(level.where(F.size("path") < depth).unionByName(joined.select(key, "path", F.to_variant_object("m").alias("v"))), "level")


def deep_merge(ours: DataFrame, theirs: DataFrame, key: str, value: str, stamp: str | None = None, prefer: dict[str, str] | None = None) -> DataFrame:
    """(``key``, ``value``): every key of either side, with the leaves of both. A side has a key once; a null value is none.

    Where both have a leaf: ``prefer`` maps a path's prefix (dotted) to "ours", "theirs" or "newest", the longest prefix decides; the
    default is "newest" if there is a ``stamp`` column (ours on a tie), else "ours". Where one side has a leaf and the other an object
    at the same path, the side that is preferred there keeps all it has below. JSON null is a value.
    """
    rules = sorted((prefer or {}).items(), key=lambda r: -len(r[0].split(".")))

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.where(F.col(value).isNotNull()).select(key, F.col(value).alias(name), F.coalesce(F.col(stamp).cast("string") if stamp else F.lit(""), F.lit("")).alias(f"{name}_stamp"))

    # What one side has alone is whole already: only keys of both sides are taken apart.
    pairs = written(side(ours, "ours").join(side(theirs, "theirs"), key, "full_outer"), "pairs")
    alone = pairs.where("ours IS NULL OR theirs IS NULL").select(key, F.coalesce("ours", "theirs").alias(value))
    pairs = pairs.where("ours IS NOT NULL AND theirs IS NOT NULL")
    both = pairs.select(key, F.explode(F.array(*[F.struct(F.lit(n).alias("side"), F.col(n).alias("v")) for n in ("ours", "theirs")])).alias("s")).select(key, "s.side", F.col("s.v").alias("value_"))
    both = _leaves(both, [key, "side"], "value_")
    stamps = pairs.select(key, F.col("ours_stamp").alias("a"), F.col("theirs_stamp").alias("b"))
    newest = F.when(F.col("a") >= F.col("b"), "ours").otherwise("theirs")
    wins = newest if stamp else F.lit("ours")
    decided = F.lit(None).cast("string")
    for prefix, who in reversed(rules):
        names = F.array(*map(F.lit, prefix.split(".")))
        decided = F.when(F.slice("path", 1, len(prefix.split("."))) == names, newest if who == "newest" else F.lit(who)).otherwise(decided)
    above = F.transform(F.sequence(F.lit(0), F.size("path")), lambda n: F.slice("path", F.lit(1), n))
    has = both.select(key, F.when(F.col("side") == "ours", "theirs").otherwise("ours").alias("side"), F.explode(above).alias("path")).distinct()
    # A path that is a leaf of one side and that the other side has, too: none is below another one, and the rule decides each.
    met = both.select(key, "side", "path").join(has, [key, "side", "path"]).select(key, "path").distinct()
    lost = met.join(stamps, key).select(key, "path", F.when(F.coalesce(decided, wins) == "ours", "theirs").otherwise("ours").alias("side"))
    dropped = both.select(key, "side", F.col("path").alias("leaf"), F.explode(above).alias("path")).join(lost, [key, "side", "path"]).select(key, "side", F.col("leaf").alias("path"))
    kept = both.join(dropped, [key, "side", "path"], "left_anti")
    return together(kept.select(key, "path", "v"), key).withColumnRenamed("v", value).unionByName(alone)


def upsert(stored: DataFrame, batch: DataFrame, asked: DataFrame, key: str, fields: list[str], stamp: Column) -> tuple[DataFrame, DataFrame]:
    """(the table after the batch, a report (``key``, outcome, changed)).

    ``asked`` lists the keys that the batch may answer. A row of the batch is ``unasked`` if its key isn't among them, ``empty`` if it
    has no field, ``same`` if it says nothing new, else ``inserted`` or ``updated``; an asked key without a row is ``unanswered``. Fields that a
    row leaves null keep their value, so that a batch may be taken in twice. Of several rows of a key the first by its fields counts.
    """
    one = batch.groupBy(key).agg(F.min(F.struct(*fields)).alias("new"))
    may = asked.select(key).distinct().withColumn("asked", F.lit(True))
    old = stored.select(key, F.struct(*fields).alias("old"), F.col("stamp").alias("old_stamp"))
    met = old.join(one, key, "full_outer").join(may, key, "full_outer")
    says = F.coalesce(F.col("asked"), F.lit(False)) & F.col("new").isNotNull()
    changed = F.array_compact(F.array(*[F.when(says & F.col(f"new.{f}").isNotNull() & ~F.col(f"new.{f}").eqNullSafe(F.col(f"old.{f}")), F.lit(f)) for f in fields]))
    met = met.withColumn("changed", changed)
    none = ~F.greatest(*[F.col(f"new.{f}").isNotNull() for f in fields], F.lit(False))
    outcome = (
        F.when(F.col("new").isNull() & F.col("asked"), "unanswered").when(F.col("new").isNotNull() & F.col("asked").isNull(), "unasked").when(F.col("new").isNotNull() & none, "empty")
        .when(F.col("new").isNotNull() & (F.size("changed") == 0), "same").when(says & F.col("old").isNull(), "inserted").when(says, "updated")
    )
    met = written(met.withColumn("outcome", outcome), "upsert")
    after = met.where(F.col("old").isNotNull() | (F.col("outcome") == "inserted"))
    values = [F.when(F.array_contains("changed", f), F.col(f"new.{f}")).otherwise(F.col(f"old.{f}")).alias(f) for f in fields]
    return after.select(key, *values, F.when(F.size("changed") > 0, stamp).otherwise(F.col("old_stamp")).alias("stamp")), met.where(F.col("outcome").isNotNull()).select(key, "outcome", "changed")
