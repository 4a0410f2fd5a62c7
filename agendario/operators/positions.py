"""A positional word index, phrases found in it, and phrases near names: claims checked against texts.

The index has a row per word and place of a text (keys as by ``norm_key``). A phrase is looked for by its rarest word: these rows
alone become candidates, and the other words confirm them by equi-joins on (text, place, word). Claims need no index: their phrases
are found by ``dictionary.phrases_in``. Whether a phrase is near a name is
decided by the last name before and the next one after it in order of place: no pair of places is made, however often both occur.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_key
from ..sources.tables import written
from .dictionary import phrases_in
from .lookup import sized


def index(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(``key``, pos, word, at): every word of a text's key with its number and the place of its first letter, both from 0."""
    one = docs.select(key, F.split(norm_key(F.col(text)), " ").alias("ws"))
    words = one.select(key, F.posexplode("ws").alias("pos", "word")).where("word <> ''")
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return words.withColumn("at", F.coalesce(F.sum(F.length("word") + 1).over(before), F.lit(0)).cast("long"))


def occurrences(places: DataFrame, key: str, phrases: DataFrame) -> DataFrame:
    """(``key``, phrase, pos, at, end): where the index has the phrases (a column of keys), whole words in a row. ``key`` is unique per text."""
    words = phrases.select("phrase").where("phrase <> ''").distinct().select("phrase", F.posexplode(F.split("phrase", " ")).alias("i", "word"))
    known = places.join(sized(words.select("word").distinct()), "word", "left_semi")
    often = known.groupBy("word").agg(F.count("*").alias("n"))
    counted = words.join(often, "word", "left").groupBy("phrase").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "i", "word")).alias("rare"), F.max("i").alias("last"))
    anchors = known.join(sized(counted.where("rare.n > 0").select("phrase", F.col("rare.word").alias("word"), F.col("rare.i").alias("i"), "last")), "word")
    starts = anchors.select(key, "phrase", (F.col("pos") - F.col("i")).alias("pos"), "last")
    single = starts.where("last = 0").join(known.select(key, "pos", "at", (F.col("at") + F.length("word")).alias("end")), [key, "pos"]).select(key, "phrase", "pos", "at", "end")
    wanted = starts.where("last > 0 AND pos >= 0").join(sized(words), "phrase").select(key, "phrase", F.col("pos").alias("start"), (F.col("pos") + F.col("i")).alias("pos"), "word", "last")
    there = wanted.join(known, [key, "pos", "word"]).groupBy(key, "phrase", "start", "last").agg(F.count("*").alias("n"), F.min("at").alias("at"), F.max(F.col("at") + F.length("word")).alias("end"))
    return single.unionByName(there.where("n = last + 1").select(key, "phrase", F.col("start").alias("pos"), "at", "end"))


def near_names(docs: DataFrame, key: str, text: str, claims: DataFrame, reach: int = 600) -> DataFrame:
    """(``key``, claim, distance): the claims (claim, name, phrase) whose phrase a text has at most ``reach`` characters from the name.

    ``distance`` is the least number of characters between a place of the phrase and one of the name, in the text's key; 0 where they overlap.
    """
    asked = claims.select("claim", norm_key(F.col("name")).alias("name"), norm_key(F.col("phrase")).alias("phrase")).where("name <> '' AND phrase <> ''")
    phrases = asked.select("phrase").unionByName(asked.select(F.col("name").alias("phrase")))
    # Each text is read once for all phrases; only places of phrases are written, not every word's.
    found = phrases_in(docs, key, text, phrases, "phrase", longest=False).withColumn("end", F.col("at") + F.length("phrase"))
    found = written(found, "occurrences")
    as_name = found.join(asked.select("claim", F.col("name").alias("phrase")), "phrase").select(key, "claim", "at", "end", F.lit(True).alias("is_name"))
    as_phrase = found.join(asked.select("claim", "phrase"), "phrase").select(key, "claim", "at", "end", F.lit(False).alias("is_name"))
    # A name of the same place comes first, so that it is before its phrase; both ways look at all rows of the text and claim.
    order = Window.partitionBy(key, "claim").orderBy("at", F.desc("is_name"), "end")
    before = F.max(F.when(F.col("is_name"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(F.when(F.col("is_name"), F.col("at")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    gaps = as_name.unionByName(as_phrase).withColumns({"left": F.when(before.isNotNull(), F.greatest(F.lit(0), F.col("at") - before)), "right": F.when(after.isNotNull(), F.greatest(F.lit(0), after - F.col("end")))})
    return gaps.where("NOT is_name").groupBy(key, "claim").agg(F.min(F.least("left", "right")).cast("long").alias("distance")).where(F.col("distance") <= reach)
