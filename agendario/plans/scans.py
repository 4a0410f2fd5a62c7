"""Queries of the scans, over pages and files made from ``events``, ``orders`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, similarity, text
from ..sources import readers
from ..sources.tables import table
from .catalog import query

_DAY = "strftime(ts, '%Y-%m-%d')"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "HH:mm").alias("hour"), "event_type", F.col("user_id").cast("string").alias("user"))


@query("""SELECT event_id, event_type || ' ' || user_id AS name, CAST(ts AS DATE) AS day, nullif(strftime(ts, '%H:%M'), '00:00') AS hour, 'Sala ' || user_id AS venue, '12' AS price FROM events""", days=("day",))
def ld_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit('<html><script type="application/ld+json">{"@type":"MusicEvent","name":"'), "event_type", F.lit(" "), "user", F.lit('","startDate":"'), "day", F.lit("T"), "hour", F.lit(':00","location":{"name":"Sala '), "user", F.lit('"},"offers":{"price":"12"}}</script></html>'))
    return readers.json_ld(_events(spark, sf_dir).select("event_id", page.alias("html")), "event_id", "html")


@query(f"""SELECT event_id, event_type AS name, CAST(ts AS DATE) AS day, 'Sala ' || user_id AS venue, CASE WHEN event_id % 2 = 0 THEN '9' END AS price FROM events WHERE event_id % 3 < 2
UNION ALL SELECT event_id, 'inner ' || event_type, CAST(ts AS DATE), NULL, NULL FROM events WHERE event_id % 3 = 1""", days=("day",))
def graph_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    one = F.concat(F.lit('{"@type":"Event","name":"'), "event_type", F.lit('","startDate":"'), "day", F.lit('","location":{"name":"Sala '), "user", F.lit('"}'), F.when(F.col("event_id") % 2 == 0, ',"offers":{"price":"9"}').otherwise(""), F.lit("}"))
    inner = F.concat(F.lit('{"@type":"ListItem","item":{"@type":"MusicEvent","name":"inner '), "event_type", F.lit('","startDate":"'), "day", F.lit('"}}'))
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"@graph":['), one, F.lit(',{"@type":"Place"}]}'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), one, F.lit(',{"itemListElement":['), inner, F.lit("]}]"))).otherwise("not json")
    return readers.graph_events(e.select("event_id", raw.alias("raw")), "event_id", "raw")


@query("""SELECT event_id, CAST(0 AS INT) AS pos, event_type AS name, CAST(ts AS DATE) AS day, strftime(ts, '%H:%M') AS hour, CASE WHEN event_id % 2 = 0 THEN '8' END AS price FROM events""", days=("day",))
def micro_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(
        F.lit('<div itemscope itemtype="http://schema.org/MusicEvent"><h2 itemprop="name"> '), "event_type", F.lit('</h2><time itemprop="startDate" datetime="'), "day", F.lit("T"), "hour", F.lit('"></time>'),
        F.when(F.col("event_id") % 2 == 0, '<meta itemprop="price" content="8">').otherwise(""), F.lit('</div><div itemscope itemtype="http://schema.org/Place"><b itemprop="name">x</b></div>'),
    )
    return readers.microdata(_events(spark, sf_dir).select("event_id", page.alias("html")), "event_id", "html")


@query("""SELECT event_id, CAST(unnest([0, 1]) AS INT) AS pos, event_type AS name, CAST(ts AS DATE) AS day, CASE WHEN unnest([0, 1]) = 0 THEN strftime(ts, '%H:%M') END AS hour, 'u' || user_id AS url FROM events""", days=("day",))
def calendar_events_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = F.concat(F.lit('{"title":"'), "event_type", F.lit('","url":"u'), "user", F.lit('","start":"'), "day")
    return readers.calendar_json(_events(spark, sf_dir).select("event_id", F.concat(F.lit("["), one, F.lit("T"), "hour", F.lit('"},'), one, F.lit('"}]')).alias("raw")), "event_id", "raw")


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'microdata' ELSE 'lines' END AS how, event_type AS name, CAST(ts AS DATE) AS day, CASE WHEN event_id % 3 < 2 THEN nullif(strftime(ts, '%H:%M'), CASE WHEN event_id % 3 = 0 THEN '00:00' ELSE '' END) END AS hour FROM events""", days=("day",))
def scans_in_turn(spark: SparkSession, sf_dir: str) -> DataFrame:
    ld = F.concat(F.lit('<script type="application/ld+json">{"@type":"Event","name":"'), "event_type", F.lit('","startDate":"'), "day", F.lit("T"), "hour", F.lit('"}</script>'))
    micro = F.concat(F.lit('<p itemscope itemtype="https://schema.org/Event"><b itemprop="name">'), "event_type", F.lit('</b><i itemprop="startDate" content="'), "day", F.lit("T"), "hour", F.lit('"></i></p>'))
    lines = F.concat(F.lit("<p>"), "day", F.lit("</p><p>"), "event_type", F.lit("</p>"))
    page = F.when(F.col("event_id") % 3 == 0, F.concat(ld, lines)).when(F.col("event_id") % 3 == 1, F.concat(micro, lines)).otherwise(lines)
    return readers.first_that_reads(_events(spark, sf_dir).select("event_id", page.alias("html")), "event_id", "html")


_FILE = "'User-agent: *' || chr(10) || 'Disallow: /a' || (o_custkey % 3) || chr(10) || 'Allow: /a1/b' || chr(10) || 'Crawl-delay: 5' || chr(10) || 'User-agent: Own' || chr(10) || 'Disallow: /x*y' || CASE WHEN o_orderkey % 2 = 0 THEN chr(10) || 'Crawl-delay: 2.5' ELSE '' END"


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 2.5 ELSE 5.0 END AS delay FROM orders""")
def crawl_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_FILE.replace("chr(10)", "'\\n'")).alias("text"))
    return readers.crawl_delay(files, "o_orderkey", "text", "own", fallback=True)


@query("""SELECT o_orderkey, '/a1/' || CASE WHEN o_orderkey % 4 = 0 THEN 'b' ELSE 'c' END AS path, o_custkey % 3 <> 1 OR o_orderkey % 4 = 0 AS allow FROM orders""")
def crawl_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_FILE.replace("chr(10)", "'\\n'")).alias("text"))
    rules = readers.crawl_rules(files, "o_orderkey", "text").where("agent = '*'")
    urls = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("/a1/"), F.when(F.col("o_orderkey") % 4 == 0, "b").otherwise("c")).alias("path"))
    return readers.may_fetch(urls, rules, "o_orderkey", "path")


_GROUPS = "concat_ws('\\n', 'User-agent: a' || o_custkey % 3, 'Crawl-delay: ' || o_orderkey % 4, 'User-agent: b', 'User-Agent: a1bot # both', 'Sitemap: x', 'Disallow: /p' || o_custkey % 2, 'Allow:', 'Crawl-delay: 7', 'user-agent: *', 'Disallow: /')"


@query("""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 1 AND o_orderkey % 4 > 0 THEN (o_orderkey % 4)::DOUBLE ELSE 7.0 END AS delay,
'/p' || o_orderkey % 2 || '/x$y' AS path, o_custkey % 2 <> o_orderkey % 2 AS allow FROM orders""")
def crawl_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays open and end groups; an agent has the groups whose names are part of its own, and ``*`` only without such."""
    files = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_GROUPS).alias("text"))
    urls = table(spark, sf_dir, "orders").select("o_orderkey", F.expr("'/p' || o_orderkey % 2 || '/x$y'").alias("path"))
    allowed = readers.may_fetch(urls, readers.rules_for(files, "o_orderkey", "text", "A1Bot/2.0 (+http://x)"), "o_orderkey", "path")
    return readers.crawl_delay(files, "o_orderkey", "text", "A1Bot/2.0").join(allowed, "o_orderkey").select("o_orderkey", "delay", "path", "allow")


@query("""SELECT event_id, event_type AS name, CAST(ts AS DATE) AS day, nullif(strftime(ts, '%H:%M'), '00:00') AS hour, user_id % 40 || ' EUR' AS price, 'Town ' || user_id % 7 AS town, CASE WHEN event_id % 2 = 0 THEN 'g' || user_id ELSE '' END AS guests, CAST(1 + event_id % 9 AS INT) AS depth
FROM events WHERE user_id % 40 > 0 UNION ALL SELECT event_id, event_type, CAST(ts AS DATE), nullif(strftime(ts, '%H:%M'), '00:00'), NULL, 'Town ' || user_id % 7, CASE WHEN event_id % 2 = 0 THEN 'g' || user_id ELSE '' END, CAST(1 + event_id % 9 AS INT) FROM events WHERE user_id % 40 = 0""", days=("day",))
def nested_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events 1 to 9 levels deep below members of any name, with lists of types, offers and addresses."""
    from ..sources import jsonwalk

    stamp = F.concat("day", F.lit("T"), "hour")
    people = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"performer":[{"name":"'), "event_type", F.lit('"},{"name":"g'), "user", F.lit('"}]'))).otherwise("")
    event = F.concat(F.lit('{"@type":["Thing","DanceEvent"],"name":"'), "event_type", F.lit('","startDate":"'), stamp, F.lit('","offers":[{"price":'), (F.col("user").cast("long") % 40).cast("string"), F.lit(',"priceCurrency":"EUR"}],"location":[{"address":[{"addressLocality":"Town '), (F.col("user").cast("long") % 7).cast("string"), F.lit('"}]}]'), people, F.lit("}"))
    depth = (F.col("event_id") % 9).cast("int")
    raw = F.concat(F.repeat(F.lit('{"n":1,"any":['), depth), F.lit('{"k":'), event, F.lit("}"), F.repeat(F.lit("]}"), depth))
    files = _events(spark, sf_dir).select("event_id", F.try_parse_json(raw).alias("v"))
    found = jsonwalk.event_fields(jsonwalk.walk(files, ["event_id"], "v", jsonwalk.typed("Event")), ["event_id"])
    return found.select("event_id", "name", "day", "hour", "price", "town", F.array_join("guests", "").alias("guests"), (F.size(F.split("path", r"\.any\[0\]"))).cast("int").alias("depth"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(least(o_orderkey % 1000, 600) AS BIGINT) WHEN 1 THEN 90 END AS wait FROM orders""")
def retry_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    header = F.when(k % 3 == 0, (k % 1000).cast("string")).when(k % 3 == 1, "Fri, 01 May 2026 10:01:30 GMT")
    return table(spark, sf_dir, "orders").select("o_orderkey", readers.retry_after(header, F.lit("2026-05-01 10:00:00").cast("timestamp"), least=0.0, most=600.0).cast("long").alias("wait"))


@query("""SELECT page_id, contains(lower(html), 'track(1') AND length(html) <= 20000 AS challenge FROM pages""")
def challenge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", readers.is_challenge(F.col("html"), ("track(1",)).alias("challenge"))


@query("""SELECT o_orderkey, CAST(v.href AS VARCHAR) AS href, CAST(v.rank AS INT) AS rank FROM orders, LATERAL (VALUES ('http://shop.com/' || o_custkey, 1), ('https://other.net/a?id=1', 2)) AS v(href, rank)""")
def ticket_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.concat(F.lit('<a href="https://other.net/a?utm_source=x&id=1#t">info</a><a class="b" href="http://own.org/x">own</a><a href="http://shop.com/'), F.col("o_custkey").cast("string"), F.lit('">Comprar</a><a href="https://other.net/a?id=1">again</a>'))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("http://www.own.org/p").alias("url"), page.alias("html"))
    return readers.outbound(rows, "o_orderkey", "url", "html", "comprar|entradas")


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) ELSE DATE '2026-03-05' END AS day FROM orders""", days=("day",))
def dates_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    said = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("o_orderdate", "d/M/yyyy")).otherwise("jueves 5 de marzo")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.parse_date(said, F.lit("2026-01-10").cast("date")).alias("day"))


@query("""WITH n AS (SELECT DISTINCT lower(p_name) AS a, lower(p_name || ' ' || p_type) AS b FROM part) SELECT a, b, 100.0::DOUBLE AS ratio FROM n""")
def word_set_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").select(F.lower("p_name").alias("a"), F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("b")).distinct()
    return n.select("a", "b", similarity.token_set_ratio(F.col("a"), F.col("b")).alias("ratio"))


@query("""SELECT p_partkey, p_name AS head, CAST(p_partkey % 3 AS INT) AS guests FROM part""")
def billings(spark: SparkSession, sf_dir: str) -> DataFrame:
    head, guests = text.billing(F.concat(F.col("p_name"), F.repeat(F.lit(" + guest"), (F.col("p_partkey") % 3).cast("int"))))
    return table(spark, sf_dir, "part").select("p_partkey", head.alias("head"), F.size(guests).alias("guests"))
