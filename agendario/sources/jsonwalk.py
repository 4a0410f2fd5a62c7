"""Walks through JSON of any shape and depth: the objects that a condition accepts, wherever they are.

The frontier is a table of VARIANT values. A step replaces each value that is no hit by its members (of an object) or elements (of
an array), by a generator without a shuffle; several steps are one Spark job, whose result is written,
so that the next job starts from it. It ends when nothing is left to open: no depth is fixed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean
from .tables import written

#: Levels that one job opens.
STEPS = 4


def parsed(raw: Column) -> Column:
    """The JSON of a text, once more without control characters where it can't be read with them; null if it is none."""
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(F.regexp_replace(raw, r"[\x00-\x1f]", " ")))


def part(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def first(v: Column, path: str) -> Column:
    """The member at ``path``, or its first element where it is a list."""
    x = part(v, path)
    return F.coalesce(part(x, "$[0]"), x)


def text_of(v: Column, path: str = "$") -> Column:
    """A scalar as text; null for objects, lists and null. Only texts that look like an object or list are looked at again."""
    said = part(v, path, "string")
    scalar = part(v, path, "array<variant>").isNull() & part(v, path, "map<string,variant>").isNull()
    return F.when(~F.substring(said, 1, 1).isin("{", "[") | scalar, said)


def typed(suffix: str) -> Callable[[Column], Column]:
    """Objects whose ``@type`` ends in ``suffix``, or has an element that does."""

    def hit(v: Column) -> Column:
        at = "$['@type']"
        among = F.exists(part(v, at, "array<variant>"), lambda k: F.coalesce(text_of(k).endswith(suffix), F.lit(False)))
        return F.when(part(v, at).isNull(), False).otherwise(F.coalesce(among, text_of(v, at).endswith(suffix), F.lit(False)))

    return hit


def having(*names: str) -> Callable[[Column], Column]:
    """Objects that have all of these members, null or not."""

    def hit(v: Column) -> Column:
        members = F.map_keys(part(v, "$", "map<string,variant>"))
        return F.coalesce(F.forall(F.array(*map(F.lit, names)), lambda n: F.array_contains(members, n)), F.lit(False))

    return hit


def _opened(rows: DataFrame, keys: list[str], hit: Callable[[Column], Column], in_texts: bool) -> DataFrame:
    """``rows`` (``keys``, path, place, v) with ``hit``; in place of a text that looks like JSON, where ``in_texts`` says so, its JSON."""
    rows = rows.where(F.col("v").isNotNull()).withColumn("hit", F.coalesce(hit(F.col("v")), F.lit(False)))
    if not in_texts:
        return rows
    rows = rows.withColumn("said", F.when(~F.col("hit"), part(F.col("v"), "$", "string")))
    rows = rows.withColumn("is_text", F.coalesce(text_of(F.col("v")).isNotNull() & F.substring("said", 1, 1).isin("{", "["), F.lit(False)))
    v = F.when(F.col("is_text"), F.try_parse_json("said")).otherwise(F.col("v"))
    path, place = F.when(F.col("is_text"), F.concat("path", F.lit("()"))).otherwise(F.col("path")), F.when(F.col("is_text"), F.concat("place", F.array(F.lit(0)))).otherwise(F.col("place"))
    rows = rows.select(*keys, path.alias("path"), place.alias("place"), v.alias("v"), "hit", "is_text").where(F.col("v").isNotNull())
    return rows.withColumn("hit", F.when(F.col("is_text"), F.coalesce(hit(F.col("v")), F.lit(False))).otherwise(F.col("hit"))).drop("is_text")


def _step(rows: DataFrame, keys: list[str], hit: Callable[[Column], Column], in_texts: bool) -> DataFrame:
    """Hits as they are; in place of everything else, what is in it."""
    inside = rows.lateralJoin(rows.sparkSession.tvf.variant_explode_outer(F.when(~F.col("hit"), F.col("v")).outer()))
    at = F.coalesce(F.concat(F.lit("."), "key"), F.concat(F.lit("["), F.col("pos").cast("string"), F.lit("]")))
    below = inside.where(F.col("hit") | F.col("value").isNotNull()).select(
        *keys, F.when(F.col("hit"), F.col("path")).otherwise(F.concat("path", at)).alias("path"), F.when(F.col("hit"), F.col("place")).otherwise(F.concat("place", F.array("pos"))).alias("place"),
        F.when(F.col("hit"), F.col("v")).otherwise(F.col("value")).alias("v"), F.col("hit").alias("was"),
    )
    return _opened(below, [*keys, "was"], lambda v: F.col("was") | hit(v), in_texts).drop("was")


def walk(files: DataFrame, keys: list[str], value: str, hit: Callable[[Column], Column], in_texts: bool = False) -> DataFrame:
    """(``keys``, path, place, v): every hit below each row's VARIANT ``value``; a hit is not opened, so no hit is inside another.

    ``path`` names the place: ``.member``, ``[element]``, and ``()`` for JSON inside a text (which ``in_texts`` opens); ``place`` has the same as numbers, which
    sort as the elements do (members sort by name). Values that are null give
    nothing. The keys needn't be unique.
    """
    rows = files.select(*keys, F.lit("$").alias("path"), F.array().cast("array<int>").alias("place"), F.col(value).alias("v"))
    rows, found = _opened(rows, keys, hit, in_texts), None
    while True:
        for _ in range(STEPS):
            rows = _step(rows, keys, hit, in_texts)
        level = written(rows, "frontier")
        hits = level.where("hit").drop("hit")
        found = hits if found is None else found.unionByName(hits)
        rows = level.where("NOT hit")
        if not rows.take(1):
            return found


def date_of(stamp: Column) -> Column:
    """The date that a stamp begins with (``2026-5-1`` too); null if there is no such day."""
    y, m, d = (F.regexp_extract(stamp, r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})", i) for i in (1, 2, 3))
    return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")


def hour_of(stamp: Column) -> Column:
    """The time of day of a stamp; midnight stands for none."""
    h, m = (F.regexp_extract(stamp, r"T(\d{1,2}):(\d{2})", i) for i in (1, 2))
    return F.when(h != "", F.nullif(F.concat(F.lpad(h, 2, "0"), F.lit(":"), m), F.lit("00:00")))


def event_fields(events: DataFrame, keys: list[str], page_url: Column | None = None) -> DataFrame:
    """Fields of schema.org events ``v``: (``keys``, path, name, guests, day, hour, venue, town, price, url, image).

    Of lists of places, addresses, offers and pictures the first counts. Several performers are the name and its guests. A
    price of 0 is none. Events without a readable date are left out.
    """
    members = "struct<`name`:variant,`startDate`:variant,`location`:variant,`offers`:variant,`performer`:variant,`image`:variant,`url`:variant,`@id`:variant>"
    blank = F.lit("")

    def head(name: str) -> Column:
        x = F.col(f"e.{name}")
        return F.coalesce(part(x, "$[0]"), x)

    # In steps, so that nothing is read out of a value twice.
    read = events.withColumn("e", part(F.col("v"), "$", members)).withColumn("stamp", text_of(F.col("e.startDate")))
    read = read.select("*", F.explode(F.array_compact(F.array(date_of(F.col("stamp"))))).alias("day"))
    read = read.withColumns({"place": head("location"), "offer": head("offers"), "picture": head("image"), "people": F.coalesce(part(F.col("e.performer"), "$", "array<variant>"), F.array("e.performer"))})
    read = read.withColumns({"address": first(F.col("place"), "$.address"), "amount": text_of(F.col("offer"), "$.price"), "people": F.transform("people", lambda p: clean(text_of(p, "$.name")))})
    read = read.withColumn("people", F.filter("people", lambda n: n.isNotNull() & (n != ""))).withColumns({"locality": clean(text_of(F.col("address"), "$.addressLocality")), "link": F.coalesce(text_of(F.col("picture"), "$.url"), text_of(F.col("picture"), "$.contentUrl"), text_of(F.col("picture")))})
    town = F.coalesce(F.nullif("locality", blank), F.nullif(clean(text_of(F.col("address"), "$.addressRegion")), blank), text_of(F.col("address")))
    free = F.col("amount").isNull() | (F.col("amount") == "") | F.coalesce(F.col("amount").try_cast("double") == 0, F.lit(False))
    price = F.trim(F.concat("amount", F.lit(" "), F.coalesce(text_of(F.col("offer"), "$.priceCurrency"), blank)))
    several = F.size("people") > 1
    url = F.coalesce(F.nullif(text_of(F.col("e.url")), blank), F.nullif(text_of(F.col("e.`@id`")), blank), page_url if page_url is not None else F.lit(None).cast("string"))
    return read.select(
        *keys, "path", F.when(several, F.get("people", F.lit(0))).otherwise(clean(text_of(F.col("e.name")))).alias("name"),
        F.when(several, F.slice("people", 2, 1 << 20)).otherwise(F.array().cast("array<string>")).alias("guests"), "day", hour_of(F.col("stamp")).alias("hour"),
        F.nullif(clean(text_of(F.col("place"), "$.name")), blank).alias("venue"), town.alias("town"), F.when(~free, price).alias("price"), url.alias("url"), F.when(F.col("link").startswith("http"), F.col("link")).alias("image"),
    )
