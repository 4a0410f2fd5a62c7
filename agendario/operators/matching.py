"""What makes two announcements one event, as tables of facts: names that are alike, venues that are one, acts under two names.

Facts are about distinct names and venues of a block (a day), not about pairs of announcements: however many announcements
have a name, it is compared once. Every comparison sits behind an equi-join: on rare grams (``simjoin``), on phrases, on words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import head, words
from ..functions.similarity import lcs
from ..functions.text import norm_key
from ..sources.tables import written
from .simjoin import alike


@dataclass(frozen=True)
class Rules:
    """What belongs to a region or language: names that many acts have, words of venues, pairs that are never one venue."""

    generic: frozenset[str] = frozenset()
    kinds: frozenset[str] = frozenset()
    common: frozenset[str] = frozenset()
    never_same: frozenset[frozenset[str]] = frozenset()
    least_name: float = 90.0
    least_venue: float = 90.0
    least_sorted: float = 92.0
    far: int = 120
    #: Phrases after which a name isn't the name any more, and words between parts of a title (fixed values of the language).
    turns: tuple[str, ...] = ("presenta", "presentan", "presentando", "en concierto", "tour", "gira", "live in", "en madrid", "world tour")
    between: tuple[str, ...] = ("by", "presenta", "presentan", "presentando", "con", "en concierto", "and friends", "feat", "ft")
    #: Words of shows that are given several times a day (fixed values of the language).
    sessions: tuple[str, ...] = ("tributo", "homenaje", "candlelight", "ballet", "musical", "espectaculo", "sesion", "matinal", "matinee", "infantil", "familiar", "cabaret", "opera", "zarzuela", "orquesta", "sinfonico", "sinfonica", "pase", "turno")
    #: Words that tell no festival from another, and articles (fixed values of the language).
    festival_words: tuple[str, ...] = ("madrid", "festival", "fest", "en", "de", "del", "la", "el", "los", "las", "y", "edicion", "the", "music", "primer", "primera", "segundo", "segunda", "tercer", "tercera")
    articles: tuple[str, ...] = ("the", "los", "las", "del")
    #: How much of two telling words (or of the only one) two names of one act must share.
    least_act: float = 0.87


# Two single values, for pairs that a join has brought together


def ratio(a: str, b: str) -> float:
    """200 * LCS / (|a| + |b|)."""
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


def reaches(a: str, b: str, least: float) -> bool:
    return a == b or (200.0 * min(len(a), len(b)) >= least * (len(a) + len(b)) and ratio(a, b) >= least)


def like(a: str, b: str, rules: Rules) -> bool:
    """One name in two spellings; generic names only if they are equal."""
    if not a or not b or a == b:
        return a == b != ""
    if a in rules.generic or b in rules.generic:
        return False
    return reaches(a, b, rules.least_name) or (len(a) > 2 and a.replace(" ", "") == b.replace(" ", ""))


def like_flexible(a: str, b: str, rules: Rules) -> bool:
    """``like``, or one name is in the other as whole words (of five letters or more), or they are initials of each other."""
    if like(a, b, rules):
        return True
    short, long = sorted((a, b), key=len)
    if len(short) >= 5 and f" {short} " in f" {long} ":
        return True
    initials = "".join(w[0] for w in long.split())
    return len(initials) > 2 and short.replace(" ", "") == initials


# Names


def forms(name: Column, rules: Rules) -> Column:
    """The texts by which a name may be recognised: its key, its head, and its parts of four letters or more between signs and linking words."""
    cut = r"(?i)\s*(?:[.:|–—&+]|\s-\s|\b(?:" + "|".join(w + (r"\.?" if w in ("feat", "ft") else "") for w in rules.between) + r")\b)\s*"
    parts = F.filter(F.transform(F.split(name, cut), lambda p: norm_key(p)), lambda p: F.length(p) >= 4)
    return F.array_distinct(F.filter(F.concat(F.array(norm_key(name), F.coalesce(head(name, rules.turns), F.lit(""))), parts), lambda f: f != ""))


def generic(key: Column, rules: Rules) -> Column:
    return F.length(key) < 3 if not rules.generic else key.isin(*rules.generic) | (F.length(key) < 3)


def names_near(names: DataFrame, rules: Rules) -> DataFrame:
    """(b, h, n): the names ``n`` of each block by which the headliner ``h`` of an announcement is met, itself included.

    ``names`` has b, name and is_head. Alike are two names that are equal; neither generic and with forms of the wanted
    ratio, or equal without spaces; or one of which is in the other as whole words, if it is long enough or stands in front.
    """
    one = names.select("b", norm_key(F.col("name")).alias("key"), forms(F.col("name"), rules).alias("forms"), "is_head").where("key <> ''")
    known = one.groupBy("b", "key").agg(F.array_distinct(F.flatten(F.collect_set("forms"))).alias("forms"), F.max("is_head").alias("is_head")).withColumn("generic", generic(F.col("key"), rules))
    known = written(known, "names-known")

    telling = known.where("NOT generic").select("b", "key", F.explode("forms").alias("s"))
    short = telling.where(F.length("s") < 4).select("b", "s", F.col("s").alias("t")).distinct()
    long = telling.where(F.length("s") >= 4).withColumnRenamed("b", "in")
    fuzzy = alike(long, long, ["in"], rules.least_name).select(F.col("in").alias("b"), F.col("a").alias("s"), F.col("b").alias("t"))
    like_forms = telling.withColumnRenamed("key", "x").join(fuzzy.unionByName(short), ["b", "s"]).join(telling.select("b", F.col("key").alias("y"), F.col("s").alias("t")), ["b", "t"]).select("b", "x", "y")

    joined = known.where("NOT generic").select("b", "key", F.replace("key", F.lit(" "), F.lit("")).alias("plain")).where(F.length("plain") >= 3)
    like_plain = joined.select("b", "plain", F.col("key").alias("x")).join(joined.select("b", "plain", F.col("key").alias("y")), ["b", "plain"]).where("x <> y").select("b", "x", "y")

    split = F.split("key", " ")
    ends = F.flatten(F.transform(F.sequence(F.lit(1), F.size(split)), lambda i: F.transform(F.sequence(F.lit(1), F.size(split) - i + 1), lambda n: F.struct(F.array_join(F.slice(split, i, n), " ").alias("phrase"), (i == 1).alias("front")))))
    phrases = known.where(F.size(split) > 1).select("b", F.col("key").alias("long"), F.col("generic").alias("long_generic"), F.explode(ends).alias("p")).select("b", "long", "long_generic", "p.phrase", "p.front")
    phrases = phrases.groupBy("b", "long", "long_generic", "phrase").agg(F.max("front").alias("front"))
    within = phrases.join(known.select("b", F.col("key").alias("phrase"), F.col("generic").alias("short_generic")), ["b", "phrase"]).where("phrase <> long")
    letters, size = F.length(F.replace("phrase", F.lit(" "), F.lit(""))), F.length("phrase")
    either = F.col("long_generic") | F.col("short_generic")
    enough = (letters >= 5) | F.col("phrase").rlike("^([a-z0-9] ){2,}[a-z0-9]$") | (F.col("front") & (size >= 5) & (size >= 0.35 * F.length("long")))
    inside = within.where(F.when(either, size >= 4).otherwise((size >= 4) & enough)).select("b", F.col("phrase").alias("x"), F.col("long").alias("y"))

    every = like_forms.unionByName(like_plain).unionByName(inside).unionByName(inside.select("b", F.col("y").alias("x"), F.col("x").alias("y")))
    heads = known.where("is_head").select("b", F.col("key").alias("x"))
    met = every.join(heads, ["b", "x"], "left_semi").unionByName(heads.select("b", "x", F.col("x").alias("y")))
    return met.select("b", F.col("x").alias("h"), F.col("y").alias("n")).distinct()


# Venues


def venues_near(venues: DataFrame, rules: Rules) -> DataFrame:
    """(v, w): venue keys that are one venue, each with itself too.

    Alike are two keys without words of kinds (the whole key if nothing is left): by the wanted ratio, equal without spaces, or by
    the ratio of their sorted words; never a pair of ``never_same``.
    """
    known = venues.select("v").where("v <> ''").distinct()
    core = F.array_join(F.filter(words(F.col("v")), lambda w: ~w.isin(*(rules.kinds or ("-",)))), " ")
    known = known.select("v", F.when(core != "", core).otherwise(F.col("v")).alias("core"))
    ordered = F.array_join(F.array_sort(F.split("core", " ")), " ")
    shapes = known.select("v", F.explode(F.array(F.struct(F.lit("core").alias("how"), F.col("core").alias("s")), F.struct(F.lit("sorted").alias("how"), ordered.alias("s")))).alias("x")).select("v", "x.how", "x.s")
    pairs = alike(shapes, shapes, ["how"], min(rules.least_venue, rules.least_sorted)).where(F.col("ratio") >= F.when(F.col("how") == "core", rules.least_venue).otherwise(rules.least_sorted))
    by_shape = shapes.join(pairs.withColumnsRenamed({"a": "s", "b": "t"}), ["how", "s"]).join(shapes.select("how", F.col("v").alias("w"), F.col("s").alias("t")), ["how", "t"]).select("v", "w")
    joined = known.select("v", F.replace("core", F.lit(" "), F.lit("")).alias("s"))
    every = by_shape.unionByName(joined.join(joined.withColumnRenamed("v", "w"), "s").select("v", "w")).distinct()
    for pair in rules.never_same:
        a, *rest = sorted(pair)
        for b in rest:
            every = every.where(~(((F.col("v") == a) & (F.col("w") == b)) | ((F.col("v") == b) & (F.col("w") == a))))
    return every


# Acts


def act_score(a: Column, b: Column) -> Column:
    """How much of two telling words, or of the only one, two sets of telling words share.

    Each word of the smaller set counts as much as it is like the best of the other: 1 if it is there, its closeness by
    letters if both have four or more and it is 0.7 or over. At least one must be there as it is.
    """
    small, large = F.when(F.size(a) <= F.size(b), a).otherwise(b), F.when(F.size(a) <= F.size(b), b).otherwise(a)

    def close(w: Column, v: Column) -> Column:
        near = 1 - F.levenshtein(w, v) / F.greatest(F.length(w), F.length(v))
        return F.when(w == v, 1.0).when((F.length(w) >= 4) & (F.length(v) >= 4) & (near >= 0.7), near).otherwise(0.0)

    soft = F.aggregate(F.transform(small, lambda w: F.array_max(F.transform(large, lambda v: close(w, v)))), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(small) > 0) & F.arrays_overlap(a, b), soft / F.least(F.lit(2), F.size(small))).otherwise(0.0)


def act_words(key: Column) -> Column:
    """The distinct words of three letters or more of a name's key, in order and joined by spaces."""
    return F.array_join(F.array_distinct(F.filter(words(key), lambda w: F.length(w) >= 3)), " ")


def acts_told(announced: DataFrame, rules: Rules) -> DataFrame:
    """(b, v, ws, o_ws): the names of words ``o_ws`` that are the act that a name of words ``ws`` announces at venue ``v``.

    ``announced`` has b, v (empty: unknown), place (the venue's class, null if unknown) and ws (``act_words``). The words of the venue weigh nothing,
    nor do common words and numbers; names of nothing else are one act if they have the same two words or more. Only
    announcements of the same class of venues, or without a venue, are looked at. Names of the same words are looked at once.
    """
    def telling(ws: Column) -> Column:
        return F.filter(ws, lambda w: ~w.isin(*(rules.common or ("-",))) & ~w.rlike("^[0-9]+$"))

    own = announced.where("v <> ''").select("b", "place", "v", "ws").distinct().withColumns({"of_venue": words(F.col("v")), "all_ws": words(F.col("ws"))})
    own = own.withColumns({"mine": telling(F.array_except("all_ws", "of_venue")), "bare": F.array_sort(F.filter(F.array_except("all_ws", "of_venue"), lambda w: ~w.isin(*rules.articles)))})
    own = own.withColumn("w", F.explode(F.when(F.size("mine") > 0, F.col("mine")).otherwise(F.slice("bare", 1, 1)))).drop("all_ws")
    other = announced.select("b", "place", F.col("ws").alias("o_ws")).distinct().withColumn("w", F.explode(words(F.col("o_ws"))))
    near, nowhere = other.where("place IS NOT NULL"), other.where("place IS NULL").drop("place")
    met = own.join(near, ["b", "place", "w"]).unionByName(own.join(nowhere, ["b", "w"])).dropDuplicates(["b", "v", "ws", "o_ws"])
    o_ws = words(F.col("o_ws"))
    theirs = telling(F.array_except(o_ws, "of_venue"))
    their_bare = F.array_sort(F.filter(F.array_except(o_ws, "of_venue"), lambda w: ~w.isin(*rules.articles)))
    met = met.withColumns({"theirs": theirs, "their_bare": their_bare})
    nothing = (F.size("mine") == 0) | (F.size("theirs") == 0)
    same = F.when(nothing, (F.col("bare") == F.col("their_bare")) & (F.size("bare") >= 2)).otherwise(act_score(F.col("mine"), F.col("theirs")) >= rules.least_act)
    return met.where(same).select("b", "v", "ws", "o_ws")


def acts_near(announced: DataFrame, rules: Rules) -> DataFrame:
    """(b, v, h, o): the headliners ``o`` that are the act ``h`` announced at venue ``v`` under another name (``acts_told``).

    ``announced`` has b, h, v and place.
    """
    told = announced.withColumn("ws", act_words(F.col("h")))
    own = told.where("v <> ''").select("b", "v", "place", "h", "ws").distinct()
    other = told.select("b", F.col("place").alias("o_place"), F.col("h").alias("o"), F.col("ws").alias("o_ws")).distinct()
    met = own.join(acts_told(told, rules), ["b", "v", "ws"]).join(other, ["b", "o_ws"])
    return met.where((F.col("h") != F.col("o")) & (F.col("o_place").isNull() | (F.col("o_place") == F.col("place")))).select("b", "v", "h", "o").distinct()
