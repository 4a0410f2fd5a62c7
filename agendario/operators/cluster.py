"""Entity resolution within a day: announcements of one event become one cluster, by first fit.

Announcements are taken by (priority, unknown venue, row_id); each joins the first cluster of its day that takes it, else it opens
one. A cluster takes an announcement if, in this order,

* one of its venues is the announcement's, or either has none,
* the announcement isn't another showing of what its own source has in the cluster at another hour (shows with sessions),
* its source isn't an institution that has another page in the cluster (each page is an act of its own),
* its headliner is one of the cluster's names, or the opener's headliner is one of its names, or both are one festival, or (both
  venues known) some announcement of the cluster is the same act under another name at an hour that isn't far.

A support act that two events share joins nothing: a headliner must be met.

*On Spark.* ``matching`` finds by joins which names, venues and acts are alike, as facts about distinct names, venues and words of names.
Announcements can only meet through the same name, festival or act at the same class of venues, so the connected components
over these nodes (rounds of partial aggregations) are groups that never touch; where nobody's venue is unknown, a
name at two venues is two nodes. Edges are between nodes, not announcements, so that their number is that of the facts. First fit is
then a fold over each group in an Arrow task, many small groups to a call, which looks clusters up by (name, venue), not one after the other. Announcements that are equal
in all that counts are one, at the place of the first, so that a group has the different ones only.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import festival_key, is_festival
from ..functions.text import norm_key
from ..sources.tables import written
from . import lookup, matching
from .matching import Rules

#: Different announcements that one Arrow call takes, about.
PART_ROWS = 4000

#: What an announcement may leave out, and what stands for it.
OPTIONAL = {"source": "string", "url": "string", "institution": "boolean", "festival": "boolean"}


def groups(met: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(row_id, group): rows of ``met`` (row_id, t) that share nodes ``t``, transitively; the group is the least row_id.

    Each round every row takes the least label among the rows of its nodes and, by pointer jumping, the label of
    its label. Aggregations are partial, and no pair is made.
    """
    met = written(met.select("row_id", "t").distinct(), "nodes")
    labels = written(met.select("row_id", F.col("row_id").alias("label")).distinct(), "labels")
    for _ in range(most_rounds):
        of_node = met.join(labels, "row_id").groupBy("t").agg(F.min("label").alias("least"))
        near = met.join(of_node, "t").groupBy("row_id").agg(F.min("least").alias("near"))
        step = labels.join(near, "row_id", "left").select("row_id", "label", F.coalesce("near", "label").alias("near"))
        jump = step.select(F.col("row_id").alias("near"), F.col("near").alias("far"))
        after = written(step.join(jump, "near", "left").select("row_id", F.least("near", F.coalesce("far", "near")).alias("label"), (F.col("near") < F.col("label")).alias("moved")), "labels")
        labels = after.select("row_id", "label")
        if not after.where("moved").take(1):
            return labels.withColumnRenamed("label", "group")
    raise RuntimeError("groups did not settle")


def announced(rows: DataFrame, block: list[str]) -> DataFrame:
    """All rows as they are given, and ``mark``: a digest of all that counts, so that equal announcements have the same."""
    for name, kind in OPTIONAL.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    plain = rows.select(F.xxhash64(*block).alias("b"), F.col("row_id").cast("long").alias("row_id"), "names", F.col("venue").cast("string").alias("venue"), "priority", F.col("minutes").cast("int").alias("minutes"), F.col("source").cast("string").alias("source"), F.col("url").cast("string").alias("url"), F.coalesce("institution", F.lit(False)).alias("institution"), F.coalesce("festival", F.lit(False)).alias("festival"))
    counts = F.to_json(F.struct("b", "names", "venue", "priority", "minutes", "source", "url", "institution", "festival"))
    return plain.withColumn("mark", F.unhex(F.md5(counts)))


def keyed(rows: DataFrame) -> DataFrame:
    """The rows of ``announced`` that have names, with the keys of names and venue."""
    named = rows.withColumn("both", F.transform("names", lambda n: F.struct(n.alias("name"), norm_key(n).alias("key"))))
    named = named.withColumn("both", F.filter("both", lambda x: F.coalesce(x["key"], F.lit("")) != "")).where(F.size("both") > 0)
    return named.select("b", "row_id", F.col("both.name").alias("names"), F.coalesce(norm_key(F.col("venue")), F.lit("")).alias("v"), "priority", "minutes", "source", "url", "institution", "festival", F.col("both.key").alias("keys"), F.get("both.key", F.lit(0)).alias("h"), "mark")


def facts(rows: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(announcements with their group, near names (b, h, list), near acts (b, v, ws, list), near venues (v, list))."""
    common = F.array(*map(F.lit, rules.festival_words)).cast("array<string>")
    title = F.get("names", F.lit(0))
    shown = F.when(is_festival(title), title).when(F.col("festival"), F.concat(title, F.lit(" festival")))
    session = matching.words(F.col("h"))
    rows = rows.withColumns({
        "fest": F.nullif(F.when(shown.isNotNull(), festival_key(F.regexp_replace(shown, r"\([^)]*\)", " "), common)), F.lit("")),
        "session": F.arrays_overlap(session, F.array(*map(F.lit, rules.sessions))),
        "ws": matching.act_words(F.col("h")),
    })
    venues = written(matching.venues_near(rows.select("v"), rules), "venues-near")
    place = groups(venues.select(F.xxhash64("v").alias("row_id"), F.xxhash64("w").alias("t"))).select(F.col("row_id").alias("v_id"), F.col("group").alias("place"))
    places = venues.select("v").distinct().withColumn("v_id", F.xxhash64("v")).join(place, "v_id").drop("v_id")
    rows = written(rows.join(lookup.sized(places), "v", "left"), "announced")

    names = rows.select("b", F.posexplode("names").alias("at", "name")).select("b", "name", (F.col("at") == 0).alias("is_head")).groupBy("b", "name").agg(F.max("is_head").alias("is_head"))
    near = written(matching.names_near(names, rules), "names-near")
    acts = written(matching.acts_told(rows.select("b", "v", "place", "ws"), rules), "acts-near")

    def base(kind: str, *columns: str) -> Column:
        return F.xxhash64("b", F.lit(kind), *columns)

    # Where somebody's venue is unknown, all that have the name, festival or act may meet; else only those of one class of venues.
    nowhere = rows.where("place IS NULL")
    by_name = nowhere.select("b", F.explode("keys").alias("n")).distinct().join(near, ["b", "n"]).select(base("name", "h").alias("base"))
    by_act = nowhere.select("b", "ws").distinct().select(base("act", "ws").alias("base"))
    opened = by_name.unionByName(nowhere.where("fest IS NOT NULL").select(base("festival", "fest").alias("base"))).unionByName(by_act)
    opened = written(opened.distinct().withColumn("open", F.lit(True)), "open")

    def node(base: Column, open_: Column) -> Column:
        return F.when(open_, F.xxhash64(base, F.lit("any"))).otherwise(F.xxhash64(base, F.col("place")))

    near_open = near.withColumn("base", base("name", "h")).join(opened, "base", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    every_open = near_open.groupBy("b", "n").agg(F.min("open").alias("open"))
    # The node of the headliner stands for all that announce it at the place; a place says nothing where all nodes are open.
    heads = rows.select("b", "h", "place", F.explode("keys").alias("n")).distinct().join(every_open, ["b", "n"]).join(every_open.select("b", F.col("n").alias("h"), F.col("open").alias("h_open")), ["b", "h"])
    heads = heads.withColumn("place", F.when(~(F.col("open") & F.col("h_open")), F.col("place"))).drop("open", "h_open").distinct()
    names_met = heads.withColumnRenamed("h", "own").join(near_open, ["b", "n"]).select("b", "own", "place", node(F.col("base"), F.col("open")).alias("t"))
    shown_at = rows.where("fest IS NOT NULL").select("b", F.col("h").alias("own"), "place", base("festival", "fest").alias("base"))
    theirs = rows.select("b", F.col("h").alias("own"), "place", "ws").distinct().join(acts.select("b", F.col("o_ws").alias("ws")).distinct(), ["b", "ws"], "left_semi").select("b", "own", "place", base("act", "ws").alias("base"))
    owns = rows.where("v <> ''").select("b", F.col("h").alias("own"), "place", "v", "ws").distinct().join(acts, ["b", "v", "ws"]).select("b", "own", "place", base("act", "o_ws").alias("base"))
    others = shown_at.unionByName(theirs).unionByName(owns).distinct().join(opened, "base", "left").select("b", "own", "place", node(F.col("base"), F.col("open")).alias("t"))
    met = names_met.unionByName(others).withColumn("base", base("name", "own")).join(opened, "base", "left").select(node(F.col("base"), F.col("open")).alias("row_id"), "t")
    tied = groups(met.distinct()).select(F.col("row_id").alias("node"), "group")
    told = rows.withColumn("base", base("name", "h")).join(opened, "base", "left").withColumn("node", node(F.col("base"), F.col("open"))).drop("base", "open").join(tied, "node")
    lists = [near.groupBy("b", "h").agg(F.collect_list("n").alias("list")), acts.groupBy("b", "v", "ws").agg(F.collect_list("o_ws").alias("list")), venues.groupBy("v").agg(F.collect_list("w").alias("list"))]
    return written(told.drop("node"), "tied"), *lists


class _Found:
    """The clusters of a group, in the order in which they were opened, by what leads to them: (fact, venue), and the fact alone."""

    def __init__(self, far: int) -> None:
        self.far, self.all, self.at, self.anywhere = far, [], defaultdict(list), defaultdict(list)

    def _enter(self, i: int, facts: set, venues: set) -> None:
        for f in facts:
            for v in venues or ("",):
                insort(self.at[f, v], i)

    def _fits(self, i: int, r: dict) -> bool:
        """The guards: not another showing of what the source has there, not another page of an institution."""
        said = self.all[i]["said"].get(r["source"], ()) if r["source"] is not None else ()
        if r["session"] and r["minutes"] is not None and any(m is not None and m != r["minutes"] for m, _ in said):
            return False
        return not (r["institution"] and r["url"] is not None and any(u is not None and u != r["url"] for _, u in said))

    def first(self, r: dict, near_names: list, near_acts: list, near_venues: list) -> int | None:
        """The first cluster that takes the announcement."""
        facts = [("n", n) for n in near_names] + [("o", k) for k in r["keys"]] + ([("f", r["fest"])] if r["fest"] is not None else [])
        best, guarded = len(self.all), r["session"] or r["institution"]
        found = [self.at.get((f, v), ()) for f in facts for v in (*near_venues, "")] if r["v"] else [self.anywhere.get(f, ()) for f in facts]
        for ids in found:
            for i in ids:
                if i >= best:
                    break
                if not guarded or self._fits(i, r):
                    best = i
                    break
        for a in near_acts if r["v"] else ():
            for v in near_venues:
                for i in self.at.get((("a", a), v), ()):
                    if i >= best:
                        break
                    hours = self.all[i]["hours"][a]
                    if (r["minutes"] is None or None in hours or any(abs(m - r["minutes"]) <= self.far for m in hours)) and (not guarded or self._fits(i, r)):
                        best = i
                        break
        return best if best < len(self.all) else None

    def add(self, i: int | None, r: dict, near_names: list) -> None:
        if i is None:
            i = len(self.all)
            self.all.append({"rows": [], "facts": set(), "venues": set(), "hours": defaultdict(set), "said": defaultdict(set)})
            new = {("o", n) for n in near_names}
        else:
            new = set()
        c = self.all[i]
        c["rows"].append(r["row_id"])
        c["said"][r["source"]].add((r["minutes"], r["url"]))
        c["hours"][r["ws"]].add(r["minutes"])
        new |= {("n", k) for k in r["keys"]} | {("a", r["ws"])} | ({("f", r["fest"])} if r["fest"] is not None else set())
        new -= c["facts"]
        if r["v"] and r["v"] not in c["venues"]:
            if not c["venues"]:
                for f in c["facts"]:
                    ids = self.at[f, ""]
                    del ids[bisect_left(ids, i)]
            self._enter(i, c["facts"], {r["v"]})
            c["venues"].add(r["v"])
        self._enter(i, new, c["venues"])
        for f in new:
            insort(self.anywhere[f], i)
        c["facts"] |= new


_TAKEN = pa.schema([("first", pa.int64()), ("cluster_id", pa.int64())])


def _first_fit(far: int):
    """First fit over each of some groups: its announcements, and the lists of near names, acts and venues that they need."""

    def fold(table: pa.Table) -> pa.Table:
        by_group, taken = defaultdict(list), []
        for r in table.to_pylist():
            by_group[r["group"]].append(r)
        for own in by_group.values():
            taken += fitted(own)
        return pa.Table.from_arrays([pa.array([t[i] for t in taken], pa.int64()) for i in (0, 1)], schema=_TAKEN)

    def fitted(own: list[dict]) -> list[tuple]:
        names, acts, venues, rows = {}, {}, {}, []
        for r in own:
            if r["kind"] == "name":
                names[r["h"]] = r["list"]
            elif r["kind"] == "act":
                acts[r["v"], r["ws"]] = r["list"]
            elif r["kind"] == "venue":
                venues[r["v"]] = r["list"]
            else:
                rows.append(r)
        rows.sort(key=lambda r: (r["priority"] is not None, r["priority"] or 0, r["v"] == "", r["row_id"]))
        found = _Found(far)
        for r in rows:
            near = names.get(r["h"], [])
            found.add(found.first(r, near, acts.get((r["v"], r["ws"]), []), venues.get(r["v"], [])), r, near)
        return [(row, min(c["rows"])) for c in found.all for row in c["rows"]]

    return fold


def clusters(rows: DataFrame, block: list[str], rules: Rules = Rules()) -> DataFrame:
    """(row_id, cluster_id) of ``rows``: block columns, row_id (unique), names (headliner first), venue ('' or null: unknown), priority, minutes.

    Further columns count where they are given: source and url (of the announcement's own page, null if it has none), institution
    and festival (booleans). The cluster's id is its least row_id. A row without names is a cluster of its own.
    """
    every = written(announced(rows, block), "announcements")
    first = every.groupBy("mark").agg(F.min("row_id").alias("row_id"))
    # Keys are made for different announcements only, and once.
    different = written(keyed(every.join(first, ["mark", "row_id"], "left_semi")), "different")
    told, near, acts, venues = facts(different, rules)
    fields = ["row_id", "keys", "h", "v", "ws", "priority", "minutes", "source", "url", "institution", "session", "fest"]
    lists = [
        told.select("group", "b", "h").distinct().join(near, ["b", "h"]).select("group", F.lit("name").alias("kind"), "h", "list"),
        told.select("group", "b", "v", "ws").distinct().join(acts, ["b", "v", "ws"]).select("group", F.lit("act").alias("kind"), "v", "ws", "list"),
        told.select("group", "v").distinct().join(lookup.sized(venues), "v").select("group", F.lit("venue").alias("kind"), "v", "list"),
    ]
    tagged = told.select("group", F.lit("row").alias("kind"), *fields)
    for facts_ in lists:
        tagged = tagged.unionByName(facts_, allowMissingColumns=True)
    # Most groups are small: a call has all groups of a part, whole.
    parts = max(1, told.count() // PART_ROWS)
    fitted = tagged.groupBy(F.pmod(F.xxhash64("group"), F.lit(parts)).alias("part")).applyInArrow(_first_fit(rules.far), "first long, cluster_id long")
    of_mark = first.withColumnRenamed("row_id", "first").join(fitted, "first").select("mark", "cluster_id")
    return every.select("row_id", "mark").join(of_mark, "mark", "left").select("row_id", F.coalesce("cluster_id", "row_id").alias("cluster_id"))
