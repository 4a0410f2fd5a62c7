"""Queries of evidence, states, fills and sources, over ``lineitem``, ``part``, ``events``, ``orders`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evidence, metrics
from ..sources.tables import table
from .catalog import _A, announcements, query

#: The vote of a line: its source is the line number, a style is the part's brand (odd lines) or a genre its type.
_V = """v AS (SELECT l_suppkey, l_linenumber AS source, CASE WHEN l_linenumber % 2 = 1 THEN 'style' ELSE 'genre' END AS kind, CASE WHEN l_linenumber % 2 = 1 THEN p_brand ELSE p_type END AS name,
CAST(l_quantity AS INT) % 4 AS rank, l_returnflag = 'R' AS weak, l_linenumber IN (3, 6) AS doubtful FROM lineitem JOIN part ON l_partkey = p_partkey),
g(name, kind, "group") AS (SELECT DISTINCT p_brand, 'style', 'G' || (length(p_brand) % 2 + CAST(right(p_brand, 1) AS INT) % 5) FROM part UNION ALL SELECT DISTINCT p_type, 'genre', 'G' || (length(p_type) % 5) FROM part),
w(source, kind, weight) AS (SELECT range, CASE WHEN range % 2 = 1 THEN 'style' ELSE 'genre' END, 1.0 / range FROM range(1, 8))"""


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")  # noqa: E741
    odd = F.col("l_linenumber") % 2 == 1
    return l.join(p, l["l_partkey"] == p["p_partkey"]).select(
        "l_suppkey", F.col("l_linenumber").cast("int").alias("source"), F.when(odd, "style").otherwise("genre").alias("kind"), F.when(odd, F.col("p_brand")).otherwise(F.col("p_type")).alias("name"),
        (F.col("l_quantity").cast("int") % 4).alias("rank"), (F.col("l_returnflag") == "R").alias("weak"), F.col("l_linenumber").isin(3, 6).alias("doubtful"),
    )


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    by_brand = p.select(F.col("p_brand").alias("name"), F.lit("style").alias("kind"), F.concat(F.lit("G"), (F.length("p_brand") % 2 + F.right("p_brand", F.lit(1)).cast("int") % 5).cast("string")).alias("group"))
    by_type = p.select(F.col("p_type").alias("name"), F.lit("genre").alias("kind"), F.concat(F.lit("G"), (F.length("p_type") % 5).cast("string")).alias("group"))
    return by_brand.unionByName(by_type).distinct()


def _weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, "style" if k % 2 else "genre", 1.0 / k) for k in range(1, 8)], "source int, kind string, weight double")


_WEIGHTED = f"""{_V}, x AS (SELECT v.*, w.weight * greatest(0.4, 1 - 0.15 * rank) AS weight, "group" FROM v JOIN w USING (source, kind) JOIN g USING (name, kind)),
s AS (SELECT DISTINCT l_suppkey, "group" FROM x WHERE NOT doubtful), o AS (SELECT DISTINCT l_suppkey FROM x WHERE NOT doubtful),
d AS (SELECT x.*, weak OR (doubtful AND o.l_suppkey IS NOT NULL AND max(CAST(s."group" IS NOT NULL AS INT)) OVER (PARTITION BY x.l_suppkey, source) = 0) AS weaker FROM x LEFT JOIN s ON x.l_suppkey = s.l_suppkey AND x."group" = s."group" LEFT JOIN o ON x.l_suppkey = o.l_suppkey)"""


@query(f"""WITH {_WEIGHTED}, t AS (SELECT l_suppkey, "group", sum(weight * CASE WHEN weaker THEN 0.5 ELSE 1 END) AS weight FROM d GROUP BY ALL), m AS (SELECT *, max(weight) OVER p AS best, sum(weight) OVER p AS total FROM t WINDOW p AS (PARTITION BY l_suppkey)),
k AS (SELECT *, count(*) FILTER (WHERE weight = best) OVER (PARTITION BY l_suppkey) AS ties FROM m)
SELECT l_suppkey, "group", round(weight, 6) AS weight FROM k WHERE CASE WHEN weight = best THEN ties <= 2 ELSE weight >= 0.6 * best AND weight >= 0.25 * total END""")
def groups_by_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    votes = evidence.grouped_votes(evidence.weighted(_votes(spark, sf_dir), _weights(spark)), _groups(spark, sf_dir))
    found = evidence.groups_by_evidence(evidence.doubted(evidence.tallied(votes, ["l_suppkey"]), ["l_suppkey"]), ["l_suppkey"])
    return found.select("l_suppkey", "group", F.round("weight", 6).alias("weight"))


@query(f"""WITH {_V}, i AS (SELECT DISTINCT l_suppkey, p_type AS name FROM v JOIN (SELECT DISTINCT p_brand, min(p_type) OVER (PARTITION BY p_brand) AS p_type FROM part) ON name = p_brand AND kind = 'style')
SELECT l_suppkey, kind, name, count(*) AS n FROM v WHERE NOT (kind = 'genre' AND EXISTS (SELECT 1 FROM i WHERE i.l_suppkey = v.l_suppkey AND i.name = v.name)) GROUP BY ALL""")
def votes_not_implied(spark: SparkSession, sf_dir: str) -> DataFrame:
    genre_of = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("style")).agg(F.min("p_type").alias("genre"))
    return evidence.without_implied(_votes(spark, sf_dir), ["l_suppkey"], genre_of).groupBy("l_suppkey", "kind", "name").agg(F.count("*").alias("n"))


@query(f"""WITH {_A}, t AS (SELECT DISTINCT day, place, CASE source WHEN 'view' THEN 'wide' WHEN 'error' THEN 'wide2' ELSE 'G' || source END AS g, source FROM a), n AS (SELECT day, place, g, count(*) AS sources FROM t GROUP BY ALL),
c AS (SELECT *, g IN ('wide', 'wide2') AS umbrella, max(CAST(g NOT IN ('wide', 'wide2') AS INT)) OVER (PARTITION BY day, place) AS concrete FROM n)
SELECT day, place, g AS "group", sources, umbrella FROM c WHERE NOT umbrella OR concrete = 0""", days=("day",))
def groups_by_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = spark.createDataFrame([("view", "wide"), ("error", "wide2"), ("purchase", "Gpurchase"), ("signup", "Gsignup"), ("click", "Gclick")], "tag string, group string")
    return evidence.groups_by_tags(announcements(spark, sf_dir).withColumn("tag", F.col("source")), ["day", "place"], groups, ("wide", "wide2"))


@query("""SELECT p_partkey, CASE WHEN p_type = 'LARGE' THEN 'exact' WHEN regexp_matches(p_type, '^S') THEN 'family S' WHEN regexp_matches(p_type, 'A') THEN 'family A' END AS "group" FROM part""")
def tags_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("tag"))
    return evidence.translated(rows, spark.createDataFrame([("LARGE", "exact")], "tag string, group string"), [("^S", "family S"), ("A", "family A")]).select("p_partkey", "group")


_U = f"""{_A}, g AS (SELECT place, NULL AS weekday, hour, count(*) AS n, 1 AS any_day FROM a GROUP BY place, hour UNION ALL SELECT place, CAST(isodow(day) - 1 AS INT), hour, count(*), 0 FROM a GROUP BY place, isodow(day), hour),
w AS (SELECT *, sum(n) OVER (PARTITION BY place, any_day, weekday) AS total, row_number() OVER (PARTITION BY place, any_day, weekday ORDER BY n DESC, hour) AS r FROM g),
u AS (SELECT place, weekday, hour AS usual FROM w WHERE r = 1 AND total >= CASE any_day WHEN 1 THEN 5 ELSE 3 END AND n >= 0.1 * total),
h AS (SELECT event_id, place, CAST(isodow(day) - 1 AS INT) AS weekday, CASE WHEN event_id % 3 <> 0 THEN hour END AS hour, event_id % 10 = 1 AS conflict FROM a),
e AS (SELECT h.*, CASE WHEN hour IS NULL THEN coalesce(d.usual, p.usual) END AS estimated FROM h LEFT JOIN u d ON h.place = d.place AND h.weekday = d.weekday LEFT JOIN u p ON h.place = p.place AND p.weekday IS NULL)"""


@query(f"""WITH {_U} SELECT event_id, estimated, CASE WHEN conflict THEN 'conflict' WHEN hour IS NOT NULL THEN 'known' WHEN estimated IS NOT NULL THEN 'estimated' ELSE 'unknown' END AS hour_state FROM e""")
def hours_estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir).withColumn("weekday", F.weekday("day"))
    usual = metrics.usual_value(a, "place", "weekday", "hour", share=0.1)
    rows = a.select("event_id", "place", "weekday", F.when(F.col("event_id") % 3 != 0, F.col("hour")).alias("hour"), (F.col("event_id") % 10 == 1).alias("conflict"))
    found = evidence.estimate_hours(rows, usual, "place", "weekday", "hour")
    return found.select("event_id", "estimated", evidence.hour_state(F.col("hour"), F.col("conflict"), F.col("estimated")).alias("hour_state"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'classified' WHEN o_orderstatus = 'F' THEN 'no_style' WHEN o_orderstatus = 'O' THEN 'not_found' ELSE 'not_asked' END AS style,
CASE WHEN o_orderkey % 3 = 0 AND o_custkey % 4 > 0 THEN 'contradicted' WHEN o_orderkey % 3 = 0 THEN 'known' WHEN o_orderkey % 2 = 0 THEN 'estimated' ELSE 'unknown' END AS origin, CASE WHEN o_totalprice > 200000 THEN 'known' ELSE 'unknown' END AS price FROM orders""")
def field_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    groups = F.when(k % 5 == 0, F.array(F.lit("rock"))).otherwise(F.array().cast("array<string>"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", evidence.style_state(groups, F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F").alias("style"),
        evidence.origin_state(F.when(k % 3 == 0, "ES"), F.when(k % 2 == 0, "PT"), F.col("o_custkey") % 4).alias("origin"), evidence.two_state(F.when(F.col("o_totalprice") > 200000, 1)).alias("price"),
    )


@query("""SELECT o_orderkey, CASE WHEN n_regionkey IS NOT NULL AND s IS NOT NULL THEN greatest(n_regionkey, s) ELSE coalesce(n_regionkey, s) END AS tier FROM (SELECT o_orderkey, n_regionkey, CASE WHEN o_totalprice >= 400000 THEN 4 WHEN o_totalprice >= 200000 THEN 2 END AS s FROM orders LEFT JOIN nation ON o_custkey % 40 = n_nationkey)""")
def tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    venue_tiers = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("venue"), F.col("n_regionkey").alias("tier"))
    rows = table(spark, sf_dir, "orders").withColumn("venue", F.col("o_custkey") % 40)
    return evidence.tier(rows, venue_tiers, F.col("o_totalprice"), ((400000, 4), (200000, 2))).select("o_orderkey", "tier")


_READS = "r AS (SELECT DISTINCT user_id AS source, CAST(ts AS DATE) AS day, max(CAST(value > 60 AS INT)) OVER (PARTITION BY user_id, CAST(ts AS DATE)) = 1 AS ok FROM events)"


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("source"), F.to_date("ts").alias("day")).agg((F.max((F.col("value") > 60).cast("int")) == 1).alias("ok"))


@query(f"""WITH {_READS}, l AS (SELECT source, max(day) FILTER (WHERE ok) AS last FROM r GROUP BY source), s AS (SELECT r.source, count(*) FILTER (WHERE NOT ok AND (last IS NULL OR day > last)) AS streak FROM r JOIN l USING (source) GROUP BY r.source)
SELECT s.source, streak, last IS NULL OR last < DATE '2024-01-29' AS frozen FROM s JOIN l USING (source)""")
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = _reads(spark, sf_dir)
    frozen = evidence.frozen_sources(reads, "source", "day", "ok", F.lit("2024-01-31").cast("date")).select("source", F.lit(True).alias("frozen"))
    return evidence.failing_streak(reads, "source", "day", "ok").join(frozen, "source", "left").withColumn("frozen", F.coalesce("frozen", F.lit(False)))


@query(f"""WITH {_READS}, l AS (SELECT source, max(day) FILTER (WHERE ok) AS last FROM r GROUP BY source), f AS (SELECT * FROM l WHERE last IS NULL OR last < DATE '2024-01-29'),
m AS (SELECT DISTINCT event_type AS key, user_id AS source FROM events)
SELECT key, min(CAST(f.source IS NOT NULL AS INT)) = 1 AS frozen, min(CAST(f.source IS NOT NULL AS INT)) = 1 AND coalesce(max(last) < DATE '2024-01-01', true) AS hidden FROM m LEFT JOIN f USING (source) GROUP BY key""")
def frozen_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit("2024-01-31").cast("date")
    frozen = evidence.frozen_sources(_reads(spark, sf_dir), "source", "day", "ok", today)
    rows = table(spark, sf_dir, "events").select(F.col("event_type").alias("key"), F.col("user_id").alias("source"))
    return evidence.mark_frozen(rows, "key", "source", frozen, today)


@query("""WITH c AS (SELECT l_suppkey AS domain, l_returnflag AS field, l_linestatus = 'O' AS agree FROM lineitem), n AS (SELECT domain, field, count(*) AS n, count(*) FILTER (WHERE agree) AS same FROM c GROUP BY ALL) SELECT * FROM n WHERE n >= 3 AND same >= 0.5 * n""")
def trusted_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("domain"), F.col("l_returnflag").alias("field"), (F.col("l_linestatus") == "O").alias("agree"))
    return evidence.trusted_domains(rows, "domain", "field", "agree", share=0.5)


_HOST = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '')"


@query(f"""WITH l AS (SELECT page_id % 40 AS record, url, min(page_id % 3) AS priority FROM pages GROUP BY ALL), a AS (SELECT *, count(*) OVER (PARTITION BY url) AS uses FROM l), h AS (SELECT *, row_number() OVER (PARTITION BY record, {_HOST} ORDER BY priority, url) AS k FROM a WHERE uses = 1),
r AS (SELECT record, url, CAST(row_number() OVER (PARTITION BY record ORDER BY priority, url) AS INT) AS rank FROM h WHERE k = 1) SELECT * FROM r WHERE rank <= 4""")
def own_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to four pages of a record: the limit is the feature."""
    links = table(spark, sf_dir, "pages").select((F.col("page_id") % 40).alias("record"), "url", (F.col("page_id") % 3).alias("priority"))
    return evidence.own_pages(links, "record", "url", "priority")


@query("""WITH r AS (SELECT DISTINCT o_custkey % 100 AS k, o_custkey AS candidate, o_orderpriority AS title FROM orders WHERE o_custkey % 3 = 0), f AS (SELECT DISTINCT o_custkey % 100 AS k, o_orderpriority AS title FROM orders WHERE o_custkey % 7 = 1 AND o_orderstatus = 'F'),
n AS (SELECT k, candidate, count(*) AS shared FROM r JOIN f USING (k, title) GROUP BY ALL HAVING count(*) >= 4) SELECT k, candidate, shared FROM (SELECT *, count(*) OVER (PARTITION BY k) AS c FROM n) WHERE c = 1""")
def candidates_by_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.where("o_custkey % 3 = 0").select((F.col("o_custkey") % 100).alias("k"), F.col("o_custkey").alias("candidate"), F.col("o_orderpriority").alias("title"))
    reference = o.where("o_custkey % 7 = 1 AND o_orderstatus = 'F'").select((F.col("o_custkey") % 100).alias("k"), F.col("o_orderpriority").alias("title"))
    return evidence.shared_titles(rows, ["k"], "title", reference, 4)


@query("""WITH d AS (SELECT o_custkey, o_orderstatus, o_orderkey, CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 END AS b, o_orderdate FROM orders), u AS (SELECT o_custkey, o_orderstatus, b, o_orderdate, max(o_orderkey) AS o_orderkey FROM d GROUP BY ALL)
SELECT o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY b, o_orderdate DESC) AS r FROM u WHERE b IS NOT NULL) WHERE r = 1""", days=("day",))
def latest_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus", "o_orderdate").agg(F.max("o_orderkey").alias("o_orderkey"))
    return evidence.latest(rows, ["o_custkey"], "o_orderdate", "o_orderstatus", ("O", "F")).select("o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


@query("""WITH c AS (SELECT o_orderkey, DATE '1998-01-01' - CAST(o_orderkey % 15 AS INT) AS read_on FROM orders WHERE o_orderkey % 2 = 0), r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderpriority = '1-URGENT' AS gap FROM orders)
SELECT o_orderkey, gap FROM r LEFT JOIN c USING (o_orderkey) WHERE day >= DATE '1998-01-01' AND (read_on IS NULL OR DATE '1998-01-01' - read_on > CASE WHEN day - DATE '1998-01-01' <= 14 THEN 3 ELSE 10 END)""")
def reading_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    today = F.lit("1998-01-01").cast("date")
    cache = o.where("o_orderkey % 2 = 0").select("o_orderkey", F.date_sub(today, (F.col("o_orderkey") % 15).cast("int")).alias("read_on"))
    rows = o.select("o_orderkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderpriority") == "1-URGENT").alias("is_gap"))
    return evidence.reading_queue(rows, cache, "o_orderkey", F.col("is_gap"), "day", today).select("o_orderkey", "gap")


@query("""WITH g AS (SELECT DISTINCT o_custkey, max(o_orderstatus) OVER (PARTITION BY o_custkey) AS status FROM orders WHERE o_custkey % 2 = 0) SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END, status) AS priority, o_orderkey % 3 = 0 AND status IS NOT NULL AS filled FROM orders LEFT JOIN g USING (o_custkey)""")
def fields_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    given = o.where("o_custkey % 2 = 0").groupBy("o_custkey").agg(F.max("o_orderstatus").alias("priority"))
    rows = o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("priority"))
    return evidence.fill(rows, given, ["o_custkey"], ["priority"]).select("o_orderkey", "priority", (F.size("filled") > 0).alias("filled"))


@query("""SELECT o_orderkey, coalesce(a, b, c) AS pick, CASE WHEN a IS NOT NULL THEN 'a' WHEN b IS NOT NULL THEN 'b' WHEN c IS NOT NULL THEN 'c' END AS pick_from FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS b, CASE WHEN o_orderkey % 5 <> 0 THEN 'c' END AS c FROM orders)""")
def card_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 4 == 0, F.col("o_orderstatus")).alias("a"), F.when(k % 3 == 0, F.col("o_orderpriority")).alias("b"), F.when(k % 5 != 0, "c").alias("c"))
    return evidence.by_precedence(rows, ["a", "b", "c"], "pick").select("o_orderkey", "pick", "pick_from")


@query("""SELECT o_custkey, o_orderstatus, count(DISTINCT o_orderpriority) AS sources FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL""")
def contradictory_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("chosen", F.lit("F"))
    return evidence.contradictory(rows, ["o_custkey"], "o_orderstatus", "o_orderpriority", "chosen")


@query("""SELECT o_custkey, min(o_orderstatus) AS o_orderstatus FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1""")
def unanimous_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence.only_one(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderstatus")


@query("""WITH n AS (SELECT l_orderkey, p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL), r AS (SELECT *, max(n) OVER (PARTITION BY l_orderkey) AS b, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, p_type) AS INT) AS rank FROM n) SELECT l_orderkey, p_type, n, rank FROM r WHERE n >= 0.5 * b AND rank <= 3""")
def line_up_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")  # noqa: E741
    return evidence.line_up_groups(l.join(p, l["l_partkey"] == p["p_partkey"]).select("l_orderkey", "p_type"), ["l_orderkey"], "p_type")


@query()
def alias_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue-like names with alike words (exact; tested against all pairs)."""
    names = table(spark, sf_dir, "part").select(F.concat_ws(" ", F.lower("p_name"), F.lower(F.replace("p_brand", F.lit("#"), F.lit(" ")))).alias("key"))
    return evidence.alias_pairs(names, "key", 95.0)
