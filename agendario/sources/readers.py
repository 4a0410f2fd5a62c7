"""Scans of listings: structured data in pages, headed lists, sheets, crawl rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import let
from . import jsonwalk


def json_ld(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Schema.org events in the ``ld+json`` scripts of pages, at any depth: one row per event, day and hour apart (00:00: no hour)."""
    return ld_events(pages, key, html).select(key, "name", "day", "hour", "venue", "price")


def ld_events(pages: DataFrame, key: str, html: str, url: str | None = None) -> DataFrame:
    """``json_ld`` with every field (``jsonwalk.event_fields``); ``url`` names the column of the page's address."""
    scripts = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>'), 1)
    keys = [key, url] if url else [key]
    files = pages.select(*keys, F.explode(scripts).alias("raw")).select(*keys, jsonwalk.parsed(F.col("raw")).alias("v"))
    return jsonwalk.event_fields(jsonwalk.walk(files, keys, "v", jsonwalk.typed("Event")), [key], F.col(url) if url else None)


def title_and_links(html: Column) -> tuple[Column, Column]:
    """The title of a page and the addresses of its links."""
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1), F.regexp_extract_all(html, F.lit(r'<a href="([^"]*)"'), 1)


def headed_lines(docs: DataFrame, key: str, text: str, heading: str) -> DataFrame:
    """Lines of each text with the last heading above them; headings match the pattern ``heading``."""
    lines = docs.select(key, F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
    w = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.when(F.col("line").rlike(heading), F.col("line"))
    return lines.select(key, "pos", "line", head.isNotNull().alias("is_heading"), F.last(head, ignorenulls=True).over(w).alias("heading"))


def sheet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV listing with a header, by an explicit schema."""
    return spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE")


def _crawl_groups(files: DataFrame, key: str, text: str) -> DataFrame:
    """(key, groups): each file's groups, an array of part, agents, rules (allow, path) and delay (the last that is a number).

    A group is one or more agents in a row and all rules and delays up to the next agent; lines of other kinds are skipped.
    One fold over the file's lines, so that nothing is shuffled.
    """
    line = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|\r|\n"), lambda x: F.trim(F.substring_index(x, "#", 1)))
    fields = F.transform(F.filter(line, lambda x: F.contains(x, F.lit(":"))), lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))).alias("field"), F.trim(F.regexp_replace(x, "^[^:]*:", "")).alias("value")))
    known = F.filter(fields, lambda f: f["field"].isin("user-agent", "allow", "disallow", "crawl-delay"))
    opens = F.transform("known", lambda f, i: (f["field"] == "user-agent") & ((i == 0) | (F.get(F.col("known"), i - 1)["field"] != "user-agent")))
    starts = F.filter(F.transform(opens, lambda o, i: F.when(o, i)), lambda i: i.isNotNull())
    cut = F.transform("starts", lambda s, n: F.slice(F.col("known"), s + 1, F.coalesce(F.get(F.col("starts"), n + 1), F.size("known")) - s))
    cuts = files.select(key, known.alias("known")).select(key, "known", starts.alias("starts")).select(key, cut.alias("cuts"))

    def group(lines: Column, part: Column) -> Column:
        def values(*names: str) -> Column:
            return F.filter(lines, lambda f: f["field"].isin(*names))

        delays = F.filter(F.transform(values("crawl-delay"), lambda f: f["value"].try_cast("double")), lambda d: d.isNotNull())
        # An empty "disallow" forbids nothing, an empty "allow" allows everything.
        rules = F.filter(values("allow", "disallow"), lambda f: (f["value"] != "") | (f["field"] == "allow"))
        return F.struct(part.alias("part"), F.transform(values("user-agent"), lambda f: F.lower(f["value"])).alias("agents"), F.transform(rules, lambda f: F.struct((f["field"] == "allow").alias("allow"), f["value"].alias("path"))).alias("rules"), F.get(F.reverse(delays), F.lit(0)).alias("delay"))

    return cuts.select(key, F.transform("cuts", group).alias("groups"))


def crawl_rules(files: DataFrame, key: str, text: str) -> DataFrame:
    """robots.txt as rows: key, agent, allow, path. Agents in a row share the rules that follow them."""
    return _crawl_groups(files, key, text).select(key, F.explode("groups").alias("g")).select(key, "g.agents", "g.rules").select(key, F.explode("agents").alias("agent"), "rules").select(key, "agent", F.explode("rules").alias("r")).select(key, "agent", "r.allow", "r.path")


def _holding(agent: str) -> Column:
    """Of ``groups`` those that hold for an agent."""
    token = re.split("[/ ]", agent.lower())[0]

    def rank(g: Column) -> Column:
        return F.when(F.exists(g["agents"], lambda a: (a != "*") & F.contains(F.lit(token), a)), 2).when(F.array_contains(g["agents"], "*"), 1).otherwise(0)

    best = F.array_max(F.transform("groups", rank))
    return let(best, lambda b: F.filter("groups", lambda g: (rank(g) == b) & (b > 0)))


def groups_for(files: DataFrame, key: str, text: str, agent: str) -> DataFrame:
    """The groups that hold for an agent: those whose agents' names are part of its own, else those for ``*``. Each file is decided in its own row."""
    return _crawl_groups(files, key, text).select(key, F.explode(_holding(agent)).alias("g")).select(key, "g.*")


def rules_for(files: DataFrame, key: str, text: str, agent: str) -> DataFrame:
    """(key, allow, path): the rules of all groups that hold for an agent."""
    return groups_for(files, key, text, agent).select(key, F.explode("rules").alias("r")).select(key, "r.allow", "r.path")


def may_fetch(urls: DataFrame, rules: DataFrame, key: str, path: str) -> DataFrame:
    """Whether each path may be read: the longest matching rule decides, allow on a tie, yes without one.

    ``*`` in a rule stands for any characters and ``$`` at its end for the path's end; escapes are decoded on both sides.
    """
    plain = F.coalesce(F.try_url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), F.col("path"))
    quoted = F.regexp_replace(F.regexp_replace(plain, r"([.+?()\[\]{}|\\^$])", r"\\$1"), r"\*", ".*")
    pattern = F.concat(F.lit("(?s)^"), F.regexp_replace(quoted, r"\\\$$", r"\$"))
    known = rules.select(F.col(key).alias("of"), "allow", pattern.alias("pattern"), F.length("path").alias("size"))
    said = F.coalesce(F.try_url_decode(F.replace(F.substring_index(path, "?", 1), F.lit("+"), F.lit("%2B"))), F.col(path))
    asked = urls.select(key, path).distinct().withColumn("read_", F.when(F.contains(path, F.lit("?")), F.concat(said, F.regexp_extract(path, r"(?s)\?.*$", 0))).otherwise(said))
    hits = asked.join(known, (F.col(key) == F.col("of")) & F.expr("read_ rlike pattern"))
    best = hits.groupBy(key, path).agg(F.max_by("allow", F.struct("size", "allow")).alias("allow"))
    return asked.select(key, path).join(best, [key, path], "left").withColumn("allow", F.coalesce("allow", F.lit(True)))


def crawl_delay(files: DataFrame, key: str, text: str, agent: str, fallback: bool = False) -> DataFrame:
    """(key, delay): the seconds that a robots file asks of an agent: the first delay but 0 of the groups that hold for it; null if none.

    With ``fallback``, an agent whose own groups ask for none waits as long as ``*`` has to.
    """
    def first(agent: str) -> Column:
        return F.get(F.filter(F.transform(_holding(agent), lambda g: g["delay"]), lambda d: F.coalesce(d != 0, F.lit(False))), F.lit(0))

    return _crawl_groups(files, key, text).select(key, (F.coalesce(first(agent), first("*")) if fallback else first(agent)).alias("delay"))


def retry_after(header: Column, now: Column | None = None, default: Column | None = None, least: float = 1.0, most: float = 120.0) -> Column:
    """Seconds to wait by a Retry-After header, between ``least`` and ``most``; the default (null) for anything else.

    A header is a number of seconds; with ``now`` it may also be an HTTP date.
    """
    said = F.trim(header).try_cast("double")
    said = F.when(~F.isnan(said), said)
    if now is not None:
        stamp = F.try_to_timestamp(F.regexp_extract(header, r"(\d{2} [A-Z][a-z]{2} \d{4} \d{2}:\d{2}:\d{2})", 1), F.lit("dd MMM yyyy HH:mm:ss"))
        said = F.coalesce(said, (F.unix_timestamp(stamp) - F.unix_timestamp(now)).cast("double"))
    fallback = default.cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(said.isNull(), fallback).otherwise(F.greatest(F.lit(least), F.least(said, F.lit(most))))


def is_challenge(html: Column, marks: tuple[str, ...], most: int = 20_000) -> Column:
    """A short page with one of the marks of a check for robots."""
    return (F.length(html) <= most) & F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(F.lower(html), m))


def _micro(html: Column) -> Column:
    """The events in a page's ``itemprop`` attributes, in order: (name, day, hour, price)."""
    parts = F.filter(F.split(html, r"(?i)itemtype=\"https?://schema.org/"), lambda p: p.rlike(r"^[A-Za-z]*Event\""))

    def prop(part: Column, name: str) -> Column:
        said = F.regexp_extract(part, rf'(?is)itemprop="{name}"[^>]*?(?:content|datetime)="([^"]*)"', 1)
        text = F.trim(F.regexp_extract(part, rf'(?is)itemprop="{name}"[^>]*>([^<]*)<', 1))
        return F.nullif(F.when(said != "", said).otherwise(text), F.lit(""))

    def event(p: Column) -> Column:
        start = prop(p, "startDate")
        hour = F.nullif(F.regexp_extract(start, r"T(\d{2}:\d{2})", 1), F.lit(""))
        return F.struct(prop(p, "name").alias("name"), jsonwalk.date_of(start).alias("day"), hour.alias("hour"), prop(p, "price").alias("price"))

    return F.transform(parts, event)


def microdata(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Schema.org events in ``itemprop`` attributes: one row per ``itemscope`` of an Event type.

    A scope's part of the page runs to the next Event scope; ``content`` or ``datetime`` goes before the element's text.
    """
    return pages.select(key, F.posexplode(_micro(F.col(html))).alias("pos", "e")).select(key, "pos", "e.name", "e.day", "e.hour", "e.price")


def calendar_json(files: DataFrame, key: str, raw: str) -> DataFrame:
    """The events of a calendar's settings: every object with a title and a start, at any depth, in JSON inside texts too."""
    values = files.select(key, jsonwalk.parsed(F.col(raw)).alias("v"))
    found = jsonwalk.walk(values, [key], "v", jsonwalk.having("title", "start"), in_texts=True)
    v, start = F.col("v"), jsonwalk.text_of(jsonwalk.part(F.col("v"), "$.start"))
    pos = F.row_number().over(Window.partitionBy(key).orderBy("place", "path")) - 1
    return found.select(key, pos.alias("pos"), jsonwalk.text_of(jsonwalk.part(v, "$.title")).alias("name"), jsonwalk.date_of(start).alias("day"), F.nullif(F.regexp_extract(start, r"T(\d{2}:\d{2})", 1), F.lit("")).alias("hour"), jsonwalk.text_of(jsonwalk.part(v, "$.url")).alias("url"))


def graph_events(files: DataFrame, key: str, raw: str) -> DataFrame:
    """Objects of a JSON file whose ``@type`` is or has a name that ends in Event, at any depth and below any member."""
    values = files.select(key, jsonwalk.parsed(F.col(raw)).alias("v"))
    return jsonwalk.event_fields(jsonwalk.walk(values, [key], "v", jsonwalk.typed("Event")), [key]).select(key, "name", "day", "venue", "price")


def first_that_reads(pages: DataFrame, key: str, html: str) -> DataFrame:
    """The events of the first scan that finds some on a page: JSON-LD, else microdata, else dated lines.

    Columns: key, how, name, day, hour. Only pages without JSON-LD events go through the other scans, which
    are arrays of one row; the first that isn't empty is opened.
    """
    ld = json_ld(pages, key, html).select(key, F.lit("json_ld").alias("how"), "name", "day", "hour")
    rest = pages.select(key, html).join(ld.select(key).distinct(), key, "left_anti")
    micro = F.transform(_micro(F.col(html)), lambda e: F.struct(F.lit("microdata").alias("how"), e["name"].alias("name"), e["day"].alias("day"), e["hour"].alias("hour")))
    lines = F.transform(_dated(F.regexp_replace(html, "<[^>]*>", "\n")), lambda e: F.struct(F.lit("lines").alias("how"), e["name"].alias("name"), e["day"].alias("day"), F.lit(None).cast("string").alias("hour")))
    opened = rest.select(key, F.explode(F.when(F.size(micro) > 0, micro).otherwise(lines)).alias("e")).select(key, "e.how", "e.name", "e.day", "e.hour")
    return ld.unionByName(opened)


def _dated(text: Column) -> Column:
    """(pos, name, day) of each line that is an ISO or ``d/m/y`` date and is followed by a line with letters; empty lines don't count."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("line"))), lambda x: F.trim(x["line"]) != "")

    def day(line: Column) -> Column:
        iso = F.regexp_extract(line, r"^\s*(\d{4}-\d{2}-\d{2})\s*$", 1)
        d, m, y = (F.regexp_extract(line, r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s*$", i) for i in (1, 2, 3))
        said = F.when(iso != "", iso).when(d != "", F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")))
        return F.try_to_timestamp(said, F.lit("yyyy-MM-dd")).cast("date")

    def found(all_lines: Column) -> Column:
        marked = F.transform(all_lines, lambda x, i: F.struct(x["pos"].alias("pos"), F.trim(F.get(all_lines, i + 1)["line"]).alias("name"), day(x["line"]).alias("day")))
        return F.filter(marked, lambda x: x["day"].isNotNull() & F.coalesce(x["name"].rlike("[A-Za-z]"), F.lit(False)))

    return F.get(F.transform(F.array(lines), found), F.lit(0))


def dated_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, pos, name, day): the next line with letters after each line that is an ISO or ``d/m/y`` date."""
    return docs.select(key, F.explode(_dated(F.col(text))).alias("e")).select(key, "e.pos", "e.name", "e.day")


def outbound(pages: DataFrame, key: str, url: str, html: str, buy: str) -> DataFrame:
    """(key, href, rank): links to other hosts, each once, those whose text matches ``buy`` first, then by place."""
    from ..functions.text import url_clean, url_domain

    found = F.regexp_extract_all(html, F.lit(r'(?is)<a [^>]*href="(https?://[^"]*)"[^>]*>'), 1)
    texts = F.regexp_extract_all(html, F.lit(r'(?is)<a [^>]*href="https?://[^"]*"[^>]*>([^<]*)'), 1)
    rows = pages.select(key, url_domain(F.col(url)).alias("own"), F.posexplode(F.arrays_zip(found.alias("href"), texts.alias("said"))).alias("pos", "l"))
    rows = rows.select(key, "own", "pos", url_clean(F.col("l.href")).alias("href"), F.lower("l.said").rlike(buy).alias("buy")).where(url_domain(F.col("href")) != F.col("own"))
    once = rows.groupBy(key, "href").agg(F.min(F.struct(~F.col("buy"), F.col("pos"))).alias("place"))
    return once.select(key, "href", F.row_number().over(Window.partitionBy(key).orderBy("place")).alias("rank"))
