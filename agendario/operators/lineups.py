"""The line-up of a festival out of several announcements of it.

A cluster is a festival if an announcement says so or its title does. Its name is that of the best announcement; its line-up is
made of all announcements in the order of their priority: the lists in titles and the names beside them, each artist once in the
first spelling, without the festival's own name, other festivals, generic names and fillers. Which names are one artist comes from
``matching.names_near`` with the cluster as block; the rest is a fold over each cluster's different names
in the JVM, so that work grows with what is said, not with how often.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fields import is_filler
from ..functions.names import festival_key, is_festival
from ..functions.text import clean, norm_key
from ..sources.tables import written
from . import matching
from .matching import Rules

#: Ends of lists that tell that a line-up goes on (fixed values of the language).
OPEN_END = ("y mas", "mas", "y otros", "otros", "por confirmar", "and more", "more", "invitados", "y muchos mas", "muchos mas")


def listed(title: Column, open_end: tuple[str, ...] = OPEN_END) -> tuple[Column, Column, Column]:
    """(name, artists, incomplete) of ``FEST X (A, B y C)`` or ``FEST X: A + B``; no artists where a title has no such list."""
    inner = r"^(.+?)\s*\(([^()]+)\)\s*$"
    colon = r"^([^:]+?)\s*:\s*(.+)$"

    def entries(text: Column) -> Column:
        return F.filter(F.transform(F.split(text, r"\s*[,+/]\s*|\s+y\s+|\s+&\s+"), lambda x: clean(x)), lambda x: x != "")

    in_brackets = entries(F.regexp_extract(title, inner, 2))
    after_colon = entries(F.regexp_extract(title, colon, 2))
    by_brackets = title.rlike(inner) & is_festival(F.regexp_extract(title, inner, 1)) & (F.size(in_brackets) >= 2)
    by_colon = ~by_brackets & title.rlike(colon) & is_festival(F.regexp_extract(title, colon, 1)) & ~is_festival(F.regexp_extract(title, colon, 2))
    every = F.when(by_brackets, in_brackets).when(by_colon, after_colon).otherwise(F.array().cast("array<string>"))
    artists = F.filter(every, lambda x: ~norm_key(x).isin(*open_end))
    name = F.when(by_brackets, F.regexp_extract(title, inner, 1)).when(by_colon, F.regexp_extract(title, colon, 1)).otherwise(title)
    return clean(name), artists, F.size(artists) < F.size(every)


def line_ups(rows: DataFrame, rules: Rules = Rules(), filler: tuple[str, ...] = ()) -> DataFrame:
    """(cluster_id, festival, artists, incomplete) of the clusters that are festivals.

    ``rows`` has cluster_id, row_id, priority, names (headliner first) and festival (boolean or null).
    """
    common = F.array(*map(F.lit, rules.festival_words)).cast("array<string>")
    title = F.get("names", F.lit(0))
    known = rows.where(F.size("names") > 0).withColumn("says", F.coalesce("festival", F.lit(False)))
    # Of announcements that say the same the first counts; a cluster has as many rows as there are different ones.
    known = known.groupBy("cluster_id", "names", "says").agg(F.min(F.struct("priority", "row_id")).alias("first")).select("cluster_id", "names", "says", "first.priority", "first.row_id")
    known = written(known, "announced")
    fest = known.where(F.col("says") | is_festival(title)).groupBy("cluster_id").agg(F.min_by(title, F.struct("priority", (~F.col("says")).alias("late"), "row_id")).alias("title"))
    name, _, _ = listed(F.col("title"))
    key = festival_key(F.concat(F.col("festival_"), F.lit(" festival")), common)
    fest = fest.select("cluster_id", name.alias("festival_")).withColumn("key_", key)

    said = known.join(fest.select("cluster_id"), "cluster_id", "left_semi").select("cluster_id", "priority", "row_id", F.posexplode("names").alias("at", "name"))
    _, artists, incomplete = listed(F.col("name"))
    said = said.withColumns({"artists": artists, "incomplete": incomplete})
    each = said.select("cluster_id", "priority", "row_id", "at", "incomplete", F.posexplode(F.when(F.size("artists") > 0, F.col("artists")).otherwise(F.array("name"))).alias("n", "name"))
    generic = matching.generic(norm_key(F.col("name")), rules)
    fillers = is_filler(F.col("name"), filler) if filler else F.lit(False)
    other = each.join(fest, "cluster_id").where(~generic & ~fillers & ~is_festival(F.col("name")) & (festival_key(F.concat("name", F.lit(" festival")), common) != F.col("key_")))
    near = matching.names_near(other.select(F.col("cluster_id").alias("b"), "name", F.lit(True).alias("is_head")).distinct(), rules)
    near = near.groupBy("b", "h").agg(F.collect_list("n").alias("near"))
    # A name that comes back is near itself, so that its first place decides.
    place = F.struct("priority", "row_id", "at", "n", "name")
    other = other.withColumn("h", norm_key(F.col("name"))).groupBy("cluster_id", "h").agg(F.min(place).alias("first")).select("cluster_id", "h", "first.*")
    told = other.join(near.withColumnRenamed("b", "cluster_id"), ["cluster_id", "h"])
    grouped = told.groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct("priority", "row_id", "at", "n", "name", "h", "near"))).alias("all"))
    kind = "struct<names:array<string>,keys:array<string>>"

    def add(state: Column, x: Column) -> Column:
        grown = F.struct(F.concat(state["names"], F.array(x["name"])).alias("names"), F.concat(state["keys"], F.array(x["h"])).alias("keys"))
        return F.when(F.arrays_overlap(state["keys"], x["near"]), state).otherwise(grown).cast(kind)

    blank = F.struct(F.array().cast("array<string>").alias("names"), F.array().cast("array<string>").alias("keys")).cast(kind)
    lists = grouped.select("cluster_id", F.aggregate("all", blank, add)["names"].alias("artists"))
    more = said.groupBy("cluster_id").agg(F.max("incomplete").alias("incomplete"))
    out = fest.join(lists, "cluster_id", "left").join(more, "cluster_id")
    return out.select("cluster_id", F.col("festival_").alias("festival"), F.coalesce("artists", F.array().cast("array<string>")).alias("artists"), "incomplete")
