"""Queries of the core library and the DuckDB SQL that checks them.

The driver's tables stand in for listings: ``events`` are announcements (``event_type`` is the source,
``user_id`` the place, the hour of ``ts`` the disputed value), ``orders`` dated records of a customer,
``lineitem`` and ``part`` weighted votes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, names, similarity, text
from ..operators import agenda, lookup, metrics, resolve, simjoin, sinks, snapshot, temporal
from ..sources import readers
from ..sources.tables import table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, days: tuple[str, ...] = ()):
    """Registers a query under its function's name, with its SQL; ``days`` are dates, given out as ISO text."""

    def add(f):
        def as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({d: F.col(d).cast("string") for d in days})

        QUERIES[f.__name__] = as_text if days else f
        if sql:
            replaced = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in days)
            ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({replaced}) FROM ({sql})" if days else sql
        return f

    return add


PRIORITY = {"purchase": 1, "signup": 1, "click": 2, "view": 3, "error": 4}
_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in PRIORITY.items()) + " END"


def announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    prio = F.create_map(*[F.lit(x) for pair in PRIORITY.items() for x in pair])
    return table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").alias("day"), F.col("user_id").alias("place"), F.col("event_type").alias("source"), prio[F.col("event_type")].alias("priority"), F.hour("ts").alias("hour"), "value", "props"
    )


_A = f"a AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id AS place, event_type AS source, {_CASE} AS priority, CAST(hour(ts) AS INT) AS hour, value, props FROM events)"


@query(f"""WITH {_A}, v AS (SELECT day, place, hour, min(priority) AS best FROM a GROUP BY ALL),
p AS (SELECT day, place, count(*) AS n_versions, min(best) AS b FROM v GROUP BY ALL),
t AS (SELECT p.day, p.place, any_value(n_versions) AS n_versions, count(*) AS k, min(hour) AS h FROM p JOIN v ON p.day = v.day AND p.place = v.place AND v.best = p.b GROUP BY p.day, p.place)
SELECT day, place, n_versions, CASE WHEN k = 1 THEN h END AS value, CASE WHEN n_versions = 1 THEN 'single' WHEN k > 1 THEN 'conflict' ELSE 'resolved' END AS state FROM t""", days=("day",))
def priority_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_by_priority(announcements(spark, sf_dir), ["day", "place"], "hour", "priority")


@query(f"""WITH {_A} SELECT day, place, count(DISTINCT source) AS n_groups, CASE WHEN count(DISTINCT source) >= 2 THEN 'contrasted' ELSE 'one_source' END AS state FROM a GROUP BY day, place""", days=("day",))
def independent_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.independent_sources(announcements(spark, sf_dir), ["day", "place"], "source")


@query(f"""WITH {_A} SELECT day, place, arg_min(value, struct_pack(p := priority, e := event_id)) FILTER (WHERE value IS NOT NULL) AS value,
arg_min(hour, struct_pack(p := priority, e := event_id)) AS hour FROM a GROUP BY day, place""", days=("day",))
def first_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.first_by_priority(announcements(spark, sf_dir), ["day", "place"], ["value", "hour"], "priority", "event_id")


@query(f"""WITH {_A}, g AS (SELECT place, NULL AS weekday, hour, count(*) AS n, 1 AS any_day FROM a GROUP BY place, hour
UNION ALL SELECT place, CAST(isodow(day) - 1 AS INT), hour, count(*), 0 FROM a GROUP BY place, isodow(day), hour),
w AS (SELECT *, sum(n) OVER (PARTITION BY place, any_day, weekday) AS total, row_number() OVER (PARTITION BY place, any_day, weekday ORDER BY n DESC, hour) AS r FROM g)
SELECT place, weekday, hour AS usual, n, CAST(total AS BIGINT) AS total FROM w WHERE r = 1 AND total >= CASE any_day WHEN 1 THEN 5 ELSE 3 END AND n >= 0.25 * total""")
def usual_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = announcements(spark, sf_dir).withColumn("weekday", F.weekday("day"))
    return metrics.usual_value(rows, "place", "weekday", "hour", share=0.25)


@query(f"""WITH {_A}, d AS (SELECT source, day, count(*) AS n, count(value) AS v, count(props) AS p FROM a GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS n, CAST(round_even(100.0 * sum(v) / sum(n), 0) AS INT) AS pct_value, CAST(round_even(100.0 * sum(p) / sum(n), 0) AS INT) AS pct_props, CAST(round_even(100.0 * max(n) / sum(n), 0) AS INT) AS pct_same_day FROM d GROUP BY source""")
def source_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.profile(announcements(spark, sf_dir), "source", "day", ["value", "props"])


@query(f"""WITH {_A}, d AS (SELECT source, day < DATE '2024-01-16' AS early, day, count(*) AS n, count(CASE WHEN value > 20 THEN 1 END) AS v FROM a GROUP BY ALL),
p AS (SELECT source, early, CAST(sum(n) AS BIGINT) AS n, CAST(round_even(100.0 * sum(v) / sum(n), 0) AS INT) AS pct FROM d GROUP BY ALL)
SELECT b.source, b.pct AS was, b.n AS n_was, c.pct AS now, c.n AS n_now, b.pct >= 20 AND c.pct <= 40 AS drift FROM p b JOIN p c ON b.source = c.source AND b.early AND NOT c.early WHERE b.n >= 10 AND c.n >= 10""")
def drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = announcements(spark, sf_dir).withColumn("high", F.when(F.col("value") > 20, 1))
    early = F.col("day") < F.lit("2024-01-16").cast("date")
    b, a = (metrics.profile(rows.where(w), "source", "day", ["high"]) for w in (early, ~early))
    return metrics.drift(b, a, "source", "pct_high", 20, 40)


@query(f"""WITH {_A}, n AS (SELECT source, day, count(*) AS n FROM a GROUP BY ALL)
SELECT source, day, n, CAST(sum(n) OVER (PARTITION BY source ORDER BY day RANGE BETWEEN INTERVAL 13 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling FROM n""", days=("day",))
def rolling_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rolling_health(announcements(spark, sf_dir), "source", "day")


_VOTES = "v AS (SELECT l_suppkey, p_type, l_quantity AS w, l_returnflag FROM lineitem JOIN part ON l_partkey = p_partkey)"


def _votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")  # noqa: E741
    return l.join(p, l["l_partkey"] == p["p_partkey"]).select("l_suppkey", "p_type", F.col("l_quantity").alias("w"), "l_returnflag")


@query(f"""WITH {_VOTES}, s AS (SELECT l_suppkey, p_type, sum(w) AS weight FROM v GROUP BY ALL),
m AS (SELECT *, max(weight) OVER p AS best, sum(weight) OVER p AS total FROM s WINDOW p AS (PARTITION BY l_suppkey)),
t AS (SELECT *, count(*) FILTER (WHERE weight = best) OVER (PARTITION BY l_suppkey) AS ties FROM m)
SELECT l_suppkey, p_type, weight FROM t WHERE CASE WHEN weight = best THEN ties <= 2 ELSE weight >= 0.9 * best AND weight >= 0.15 * total END""")
def consensus_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.consensus(_votes(spark, sf_dir), ["l_suppkey"], "p_type", "w", 0.9, 0.15)


@query(f"""WITH {_VOTES}, s AS (SELECT l_suppkey, l_returnflag, p_type, max(w) AS w FROM v GROUP BY ALL)
SELECT l_suppkey, p_type, least(sum(w), 120.0) AS weight FROM s GROUP BY ALL""")
def capped_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.capped_weights(_votes(spark, sf_dir), ["l_suppkey"], "l_returnflag", "p_type", "w", 120.0)


@query("""WITH n AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderpriority, o_orderstatus AS spelling, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY CASE WHEN upper(o_orderstatus) <> o_orderstatus THEN 1 ELSE 0 END DESC, n DESC, o_orderstatus) AS r FROM n) WHERE r = 1""")
def best_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.best_spelling(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")


_TITLE = "regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"


@query(f"""SELECT url, count(DISTINCT page_id) AS owners FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS url FROM pages) GROUP BY url HAVING count(DISTINCT page_id) >= 3""")
def shared_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = readers.title_and_links(F.col("html"))[1]
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(links).alias("url"))
    return metrics.shared_by_many(rows, "url", "page_id", 3)


@query(f"""SELECT page_id, {_TITLE} AS title, CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INT) AS n_links FROM pages""")
def title_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, links = readers.title_and_links(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", title.alias("title"), F.size(links).alias("n_links"))


_OLD, _NEW = "o_orderkey % 3 <> 0", "o_orderkey % 4 <> 0"


@query(f"""SELECT o_orderkey, false AS from_cache FROM orders WHERE {_OLD} UNION ALL
SELECT o_orderkey, true FROM orders WHERE {_NEW} AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE {_OLD})""")
def cache_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return snapshot.complete_with_cache(orders.where(_OLD), orders.where(_NEW), ["o_custkey"]).select("o_orderkey", "from_cache")


@query(f"""WITH b AS (SELECT * FROM orders WHERE {_OLD}), c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE {_NEW}),
j AS (SELECT coalesce(b.o_orderkey, c.o_orderkey) AS k, b.o_orderkey AS bk, c.o_orderkey AS ck, b.o_orderstatus AS s1, c.o_orderstatus AS s2, b.o_orderpriority AS p1, c.o_orderpriority AS p2 FROM b FULL JOIN c ON b.o_orderkey = c.o_orderkey)
SELECT k AS o_orderkey, 'new' AS field, NULL AS was, NULL AS now FROM j WHERE bk IS NULL UNION ALL SELECT k, 'gone', NULL, NULL FROM j WHERE ck IS NULL
UNION ALL SELECT k, 'o_orderstatus', s1, s2 FROM j WHERE bk IS NOT NULL AND ck IS NOT NULL AND s1 IS DISTINCT FROM s2
UNION ALL SELECT k, 'o_orderpriority', p1, p2 FROM j WHERE bk IS NOT NULL AND ck IS NOT NULL AND p1 IS DISTINCT FROM p2""")
def snapshot_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    now = orders.where(_NEW).withColumns({
        "o_orderstatus": F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")),
    })
    return snapshot.changes(orders.where(_OLD), now, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@query(f"""WITH b AS (SELECT o_orderkey, min(o_orderstatus) AS s FROM orders WHERE {_OLD} GROUP BY 1), c AS (SELECT DISTINCT o_orderkey FROM orders WHERE {_NEW})
SELECT coalesce(b.o_orderkey, c.o_orderkey) AS o_orderkey, CASE WHEN c.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'kept' WHEN c.o_orderkey IS NOT NULL THEN 'new' WHEN s = 'F' THEN 'possibly_cancelled' ELSE 'carried' END AS state FROM b FULL JOIN c ON b.o_orderkey = c.o_orderkey""")
def reconcile_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    complete = spark.createDataFrame([("F", True), ("O", False)], "o_orderstatus string, complete boolean")
    return snapshot.reconcile(orders.where(_NEW), orders.where(_OLD), "o_orderkey", "o_orderstatus", complete)


@query(f"""WITH u AS (SELECT o_custkey, o_totalprice, o_orderdate, 1 AS ours FROM orders WHERE {_OLD} UNION ALL SELECT o_custkey, o_totalprice, o_orderdate, 0 FROM orders WHERE {_NEW}),
k AS (SELECT o_custkey, o_orderdate, ours, max(o_totalprice) AS o_totalprice FROM u GROUP BY ALL)
SELECT o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, ours DESC) AS r FROM k) WHERE r = 1""", days=("day",))
def merge_caches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ours, theirs = (orders.where(w).groupBy("o_custkey", "o_orderdate").agg(F.max("o_totalprice").alias("o_totalprice")) for w in (_OLD, _NEW))
    return snapshot.newest_of(ours, theirs, "o_custkey", "o_orderdate").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))


@query("""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 3 <> 0), f AS (SELECT date_trunc('week', day) AS week, min(day) AS day FROM d GROUP BY 1)
SELECT day FROM d WHERE day > DATE '2024-01-23' UNION SELECT day FROM f WHERE week > date_trunc('week', DATE '2024-01-30') - INTERVAL 21 DAYS""", days=("day",))
def copies_to_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).where(F.dayofmonth("day") % 3 != 0).distinct()
    return snapshot.copies_to_keep(days, "day", F.lit("2024-01-30").cast("date"), weeks=3)


_O = "o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus FROM orders)"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")


@query(f"""WITH {_O} SELECT a.o_orderkey, b.o_orderkey AS r_o_orderkey, CAST(abs(a.day - b.day) AS INT) AS apart FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderkey < b.o_orderkey AND abs(a.day - b.day) <= 30""")
def range_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    pairs = temporal.within_days(o, o, ["o_custkey"], "day", 30).where("o_orderkey < r_o_orderkey")
    return pairs.select("o_orderkey", "r_o_orderkey", F.abs(F.datediff("day", "r_day")).alias("apart"))


@query(f"""WITH {_O}, p AS (SELECT a.o_orderkey AS x, b.o_orderkey AS y FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderstatus = 'F' AND b.o_orderstatus = 'O' AND abs(a.day - b.day) <= 60)
SELECT x AS o_orderkey, y AS r_o_orderkey FROM (SELECT *, count(*) OVER (PARTITION BY x) AS n, count(*) OVER (PARTITION BY y) AS m FROM p) WHERE n = 1 AND m = 1""")
def unique_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    pairs = temporal.within_days(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["o_custkey"], "day", 60)
    return temporal.unique_pairs(pairs, "o_orderkey", "r_o_orderkey").select("o_orderkey", "r_o_orderkey")


@query(f"""WITH {_O}, f AS (SELECT * FROM o WHERE o_orderstatus = 'F'), p AS (SELECT DISTINCT o_custkey, day FROM o WHERE o_orderstatus = 'O'),
j AS (SELECT f.o_orderkey, p.day AS d, row_number() OVER (PARTITION BY f.o_orderkey ORDER BY abs(f.day - p.day), p.day) AS r FROM f LEFT JOIN p ON f.o_custkey = p.o_custkey)
SELECT o_orderkey, d AS nearest FROM j WHERE r = 1""", days=("nearest",))
def nearest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _orders(spark, sf_dir)
    right = o.where("o_orderstatus = 'O'").select("o_custkey", "day").distinct()
    return temporal.nearest(o.where("o_orderstatus = 'F'"), right, ["o_custkey"], "day").select("o_orderkey", "nearest")


@query(f"""WITH {_O} SELECT o_orderkey, CAST(d AS DATE) AS next_day FROM (SELECT o_orderkey, unnest((list_filter(generate_series(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + INTERVAL 40 DAYS, INTERVAL 1 DAY), lambda x: isodow(x) IN (5, 6)))[1:8]) AS d FROM o)""", days=("next_day",))
def expand_recurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = dates.recurrences(F.col("day"), F.date_add("day", 40), F.array(F.lit(5), F.lit(6)))
    return _orders(spark, sf_dir).select("o_orderkey", F.explode(days).alias("next_day"))


@query(f"""WITH {_O} SELECT o_orderkey, CAST(unnest(generate_series(CAST(day AS TIMESTAMP), CAST(day AS TIMESTAMP) + to_days(CAST(least(o_orderkey % 10, 6) AS INT)), INTERVAL 1 DAY)) AS DATE) AS night FROM o""", days=("night",))
def every_night(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _orders(spark, sf_dir).withColumn("until", F.date_add("day", (F.col("o_orderkey") % 10).cast("int")))
    return temporal.every_night(rows, "day", "until", 7).select("o_orderkey", "night")


_BANDS = "CASE WHEN d <= 120 THEN '<=120' WHEN d <= 150 THEN '<=150' WHEN d <= 180 THEN '<=180' WHEN d <= 240 THEN '<=240' WHEN d <= 365 THEN '<=365' ELSE '>365' END"


@query(f"""SELECT o_orderstatus, {_BANDS} AS band, count(*) AS n FROM (SELECT o_orderstatus, CAST(o_orderdate AS DATE) - DATE '2000-06-01' AS d FROM orders WHERE o_orderdate >= DATE '2000-06-01') GROUP BY ALL""")
def horizon_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit("2000-06-01").cast("date")
    rows = _orders(spark, sf_dir).where(F.col("day") >= today)
    return rows.groupBy("o_orderstatus", temporal.horizon_band(F.col("day"), today).alias("band")).agg(F.count("*").alias("n"))


RULES = [(r"^\d", "starts_with_digit"), ("[#*%$]{3}", "symbols"), ("License", "license"), ("@", "address"), (r"!!", "shouting")]
_WHEN = " ".join(f"WHEN regexp_matches(text, '{p}') THEN '{label}'" for p, label in RULES)


@query(f"SELECT doc_id, CASE {_WHEN} END AS reason FROM documents")
def ordered_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", resolve.ordered_rules(F.col("text"), RULES).alias("reason"))


_NORM = f"trim(regexp_replace(translate(replace(lower(translate(TEXT, '{text.ACCENTED}', '{text.PLAIN}')), '&', ' and '), '''’`´', ''), '[^a-z0-9]+', ' ', 'g'))"


@query(f"SELECT doc_id, {_NORM.replace('TEXT', 'text')} AS key FROM documents")
def norm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.norm_key(F.col("text")).alias("key"))


@query(f"SELECT doc_id FROM documents WHERE contains({_NORM.replace('TEXT', 'text')}, 'cion') AND contains({_NORM.replace('TEXT', 'text')}, 'que')")
def word_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(text.search(F.col("text"), F.lit("Ción  QUÉ"))).select("doc_id")


@query("""SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS domain FROM pages""")
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.url_domain(F.col("url")).alias("domain"))


@query("""WITH b AS (SELECT page_id, string_split(url, '#')[1] AS u FROM pages), q AS (SELECT page_id, string_split(u, '?')[1] AS base, CASE WHEN contains(u, '?') THEN regexp_replace(u, '^[^?]*\\?', '') ELSE '' END AS query FROM b),
k AS (SELECT page_id, base, list_filter(string_split(query, '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|fbclid|gclid|ref)=')) AS kept FROM q)
SELECT page_id, CASE WHEN len(kept) > 0 THEN base || '?' || array_to_string(kept, '&') ELSE base END AS url FROM k""")
def url_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.url_clean(F.col("url")).alias("url"))


_LINES = "l AS (SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INT) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents)"


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


@query(f"""WITH {_LINES} SELECT doc_id, pos, CASE WHEN regexp_matches(lower(line), 'gratis|gratuit|libre|free') THEN 0.0::DOUBLE ELSE list_min(list_transform(regexp_extract_all(line, '([0-9]+(?:[.,][0-9]{{1,2}})?)', 1), lambda x: CAST(replace(x, ',', '.') AS DOUBLE))) END AS price FROM l""")
def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least amount of every line of every document."""
    return _lines(spark, sf_dir).select("doc_id", "pos", text.price_min(F.col("line")).alias("price"))


_AT = [f"regexp_extract(line, '([0-9]+)[:.hH]([0-9]+)', {i})" for i in (1, 2)]
_BARE = "regexp_extract(line, '([0-9]+) ?[hH]', 1)"


@query(f"""WITH {_LINES}, x AS (SELECT doc_id, pos, CASE WHEN {_AT[0]} <> '' THEN {_AT[0]} ELSE {_BARE} END AS h, CASE WHEN {_AT[0]} <> '' THEN {_AT[1]} ELSE '00' END AS m FROM l)
SELECT doc_id, pos, CASE WHEN h <> '' AND length(h) <= 2 AND length(m) = 2 AND TRY_CAST(h AS INT) < 24 AND TRY_CAST(m AS INT) < 60 THEN lpad(h, 2, '0') || ':' || m END AS hour FROM x""")
def hour_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first time of day of every line of every document."""
    return _lines(spark, sf_dir).select("doc_id", "pos", dates.parse_hour(F.col("line")).alias("hour"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents), h AS (SELECT *, CASE WHEN length(line) < 60 THEN line END AS head FROM l)
SELECT doc_id, CAST(pos AS INT) AS pos, head IS NOT NULL AS is_heading, md5(last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos)) AS heading FROM h""")
def heading_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = readers.headed_lines(table(spark, sf_dir, "documents"), "doc_id", "text", r"(?s)^.{0,59}$")
    return lines.select("doc_id", "pos", "is_heading", F.md5("heading").alias("heading"))


@query("""SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events WHERE CAST(props->>'$.k' AS INT) >= 50""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.variant_get(F.parse_json("props"), "$.k", "int").alias("k")
    return table(spark, sf_dir, "events").select("event_id", k).where("k >= 50")


@query("""WITH n AS (SELECT l_suppkey, p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT l_suppkey, p_brand, n, r AS rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_brand) AS INT) AS r FROM n) WHERE r <= 8""")
def top_k_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")  # noqa: E741
    n = l.join(p, l["l_partkey"] == p["p_partkey"]).groupBy("l_suppkey", "p_brand").agg(F.count("*").alias("n"))
    rank = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(F.desc("n"), "p_brand"))
    return n.withColumn("rank", rank).where("rank <= 8")


@query("""SELECT source, lang, count(*) AS n, count(DISTINCT quality) AS n_values FROM documents JOIN labels USING (doc_id) GROUP BY source, lang HAVING count(DISTINCT quality) > 1""")
def contradictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return rows.groupBy("source", "lang").agg(F.count("*").alias("n"), F.count_distinct("quality").alias("n_values")).where("n_values > 1")


@query(f"""WITH {_A}, p AS (SELECT day, place, max(CAST(source = 'purchase' AS INT)) AS o, max(CAST(source = 'signup' AS INT)) AS t, count(DISTINCT source) AS g, max(CAST(source = 'error' AS INT)) AS c FROM a GROUP BY day, place),
s AS (SELECT day, place, CAST(4 * o + 2 * t + least(g - 1, 3) - 2 * c AS INT) AS points FROM p)
SELECT day, place, points, CASE WHEN points >= 4 THEN 'high' WHEN points >= 2 THEN 'medium' ELSE 'low' END AS level FROM s""", days=("day",))
def confidence_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = announcements(spark, sf_dir).withColumns({"official": F.col("source") == "purchase", "ticketing": F.col("source") == "signup", "conflict": F.col("source") == "error"})
    return metrics.confidence(rows, ["day", "place"], "official", "ticketing", "source", "conflict")


@query("""SELECT 'o_orderstatus' AS field, o_orderstatus AS state, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL""")
def state_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.state_histogram(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("""SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE o_totalprice > 300000) AS dear, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus""")
def report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count_if(F.col("o_totalprice") > 300000).alias("dear"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"), F.count_distinct("o_custkey").alias("customers")
    )


@query("""SELECT o_orderkey, '{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"' || CASE WHEN o_orderpriority = '1-URGENT' THEN ',"urgent":true' ELSE '' END || '}' AS json FROM orders""")
def light_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", True))
    return sinks.light(rows, "o_orderkey", ["o_custkey", "o_orderstatus", "urgent"])


@query()
def name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names that are alike by ``indel_ratio``, within blocks of one brand and type."""
    names = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.col("p_name").alias("name"))
    block = ["p_brand", "p_type"]
    texts = names.select(*block, F.col("name").alias("s"))
    alike = simjoin.alike(texts, texts, block, 75.0).where("a <> b").withColumnsRenamed({"a": "name", "b": "r_name"})
    other = names.select(*block, F.col("p_partkey").alias("r_partkey"), F.col("name").alias("r_name"))
    return alike.join(names, [*block, "name"]).join(other, [*block, "r_name"]).where("p_partkey < r_partkey").select("p_partkey", "r_partkey", "ratio")


ALIASES = [("widget", "W"), ("ring", "R"), ("red", "colour"), ("blue", "colour")]
_ALIAS = "CASE {} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ALIASES) + " END"


@query(f"""WITH w AS (SELECT p_partkey, string_split(p_name, ' ')[2] AS b, string_split(p_name, ' ')[1] AS a FROM part)
SELECT p_partkey, coalesce({_ALIAS.format("b")}, {_ALIAS.format("a")}) AS name FROM w""")
def alias_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.array(F.get(words, F.lit(1)), F.get(words, F.lit(0))).alias("tried"))
    return lookup.first_hit(rows, "p_partkey", "tried", spark.createDataFrame(ALIASES, "alias string, name string"), "alias", "name")


VENDORS = [("example.com", "A"), ("example.net", "B"), ("tionsh.example.net", "C"), ("net", "D")]


@query(f"""WITH d AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)), '^www\\.', '') AS h FROM pages),
v(s, vendor) AS (VALUES {", ".join(str(v) for v in VENDORS)}), m AS (SELECT page_id, vendor, row_number() OVER (PARTITION BY page_id ORDER BY length(s) DESC) AS r FROM d JOIN v ON h = s OR ends_with(h, '.' || s))
SELECT d.page_id, vendor FROM d LEFT JOIN m ON d.page_id = m.page_id AND r = 1""")
def vendor_of_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", text.domain_suffixes(text.url_domain(F.col("url"))).alias("suffixes"))
    return lookup.longest_suffix(rows, "page_id", "suffixes", spark.createDataFrame(VENDORS, "suffix string, vendor string"), "suffix", "vendor")


KEYWORDS = [(1, "mit license", "licensed"), (2, "que", "es_or_fr"), (3, "und", "de"), (4, "of the", "en")]
_K = _NORM.replace("TEXT", "text")
_KEYS = " ".join(f"WHEN contains(' ' || k || ' ', ' {w} ') THEN '{g}'" for _, w, g in KEYWORDS)


@query(f"SELECT doc_id, CASE {_KEYS} END AS label FROM (SELECT doc_id, {_K} AS k FROM documents)")
def keyword_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select("doc_id", text.norm_key(F.col("text")).alias("key"))
    return lookup.first_keyword(rows, "doc_id", "key", spark.createDataFrame(KEYWORDS, "pos int, keyword string, label string"))


@query(f"""WITH {_VOTES}, n AS (SELECT l_suppkey, p_type, count(*) AS n FROM v GROUP BY ALL),
r AS (SELECT *, max(n) OVER (PARTITION BY l_suppkey) AS b, CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, p_type) AS INT) AS rank FROM n) SELECT l_suppkey, p_type, n, rank FROM r WHERE n >= 0.9 * b AND rank <= 4""")
def strong_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = _votes(spark, sf_dir).groupBy("l_suppkey", "p_type").agg(F.count("*").alias("n"))
    return lookup.strong(n, ["l_suppkey"], "p_type", "n", 0.9, 4)


@query(f"""WITH {_A}, f AS (SELECT day, place, arg_min(hour, event_id) AS o FROM a WHERE source = 'purchase' GROUP BY ALL)
SELECT source, count(*) AS n, count(*) FILTER (WHERE hour = o) AS same, count(*) FILTER (WHERE hour < o) AS earlier, count(*) FILTER (WHERE hour > o) AS later FROM a JOIN f USING (day, place) WHERE source <> 'purchase' GROUP BY source""")
def hour_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir)
    return agenda.hour_accuracy(a.where("source <> 'purchase'"), a.where("source = 'purchase'"), ["day", "place"], "source", "hour", "event_id")


RATES = [("click", 0.8), ("view", 0.5), ("error", 0.3), ("signup", 0.6)]


@query(f"""WITH {_A}, q(source, rate) AS (VALUES {", ".join(str(r) for r in RATES)}), v AS (SELECT day, place, hour, max(rate) AS rate FROM a LEFT JOIN q USING (source) GROUP BY ALL)
SELECT day, place, max(hour) FILTER (WHERE rate >= 0.65) AS hour FROM v GROUP BY day, place HAVING count(*) FILTER (WHERE rate >= 0.65) = 1 AND count(*) FILTER (WHERE rate <= 0.55) = count(*) - 1 AND count(*) > 1""", days=("day",))
def hours_by_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = spark.createDataFrame(RATES, "source string, rate double")
    return agenda.hours_by_accuracy(announcements(spark, sf_dir), ["day", "place"], "hour", "source", rates)


@query("""WITH l AS (SELECT l_suppkey, l_shipdate, l_returnflag = 'A' AS o, l_partkey FROM lineitem), s AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, list(DISTINCT l_partkey) FILTER (WHERE o) AS t, list(DISTINCT l_partkey) FILTER (WHERE NOT o) AS f FROM l GROUP BY ALL)
SELECT l_suppkey, day, CAST(len(t) AS INT) AS n_theirs, CAST(len(f) AS INT) AS n_others FROM s WHERE len(t) > 0 AND len(f) > 0 AND NOT list_has_any(t, f)""", days=("day",))
def line_up_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("day"), (F.col("l_returnflag") == "A").alias("official"), "l_partkey")
    found = agenda.line_up_conflicts(rows, ["l_suppkey", "day"], "official", "l_partkey")
    return found.select("l_suppkey", "day", F.size("theirs").alias("n_theirs"), F.size("others").alias("n_others"))


@query(f"""WITH {_A}, u AS (SELECT place, max(day) AS until FROM a WHERE source = 'purchase' GROUP BY place)
SELECT event_id FROM a JOIN u USING (place) WHERE source <> 'purchase' AND day <= until AND NOT EXISTS (SELECT 1 FROM a b WHERE b.source = 'purchase' AND b.day = a.day AND b.place = a.place)""")
def official_absences(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir)
    official = a.where("source = 'purchase'")
    until = official.groupBy("place").agg(F.max("day").alias("until"))
    return agenda.absences(a.where("source <> 'purchase'"), official, ["day", "place"], "day", until, "place").select("event_id")


FIXES = [("2024-01-02", None, None, 2, "note", "any"), ("2024-01-02", 3, "view", 1, "discard", "one"), ("2024-01-05", None, "error", 3, "discard", "errors")]


@query(f"""WITH {_A}, f(d, p, s, pos, action, note) AS (VALUES {", ".join("(DATE " + repr(f[0]) + ", " + ", ".join("NULL" if x is None else repr(x) for x in f[1:]) + ")" for f in FIXES)}),
j AS (SELECT event_id, action, note, row_number() OVER (PARTITION BY event_id ORDER BY pos) AS r FROM a LEFT JOIN f ON a.day = f.d AND (p IS NULL OR p = place) AND (s IS NULL OR s = source))
SELECT event_id, action, note FROM j WHERE r = 1""")
def correction_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(FIXES, "day string, place long, source string, pos int, action string, note string").withColumn("day", F.to_date("day"))
    return agenda.apply_rules(announcements(spark, sf_dir), rules, "day", ["place", "source"]).select("event_id", "action", "note")


@query(f"""WITH {_A}, i AS (SELECT DISTINCT source, place * 1000 + hour AS item FROM a WHERE day >= DATE '2024-01-16'), p AS (SELECT DISTINCT place * 1000 + hour AS item FROM a WHERE day < DATE '2024-01-16'), c AS (SELECT item, count(*) AS k FROM i GROUP BY item)
SELECT source, count(*) AS total, count(*) FILTER (WHERE k = 1) AS exclusive, count(*) FILTER (WHERE p.item IS NULL) AS "new" FROM i JOIN c USING (item) LEFT JOIN p USING (item) GROUP BY source""")
def source_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = announcements(spark, sf_dir).withColumn("item", F.col("place") * 1000 + F.col("hour"))
    late = F.col("day") >= F.lit("2024-01-16").cast("date")
    return agenda.source_report(rows.where(late), rows.where(~late), "source", "item")


@query(f"""WITH {_A}, b AS (SELECT DISTINCT place, source FROM a WHERE day < DATE '2024-01-05'), n AS (SELECT DISTINCT place, source FROM a WHERE day >= DATE '2024-01-27'),
j AS (SELECT coalesce(b.source, n.source) AS source, b.place AS was, n.place AS now FROM b FULL JOIN n ON b.place = n.place AND b.source = n.source)
SELECT source, count(now) AS total, count(*) FILTER (WHERE was IS NULL) AS entered, count(*) FILTER (WHERE now IS NULL) AS "left" FROM j GROUP BY source""")
def group_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = announcements(spark, sf_dir)
    return agenda.movement(a.where("day < '2024-01-05'"), a.where("day >= '2024-01-27'"), "place", "source")


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) >= 4 AND max(CAST(o_orderpriority = '1-URGENT' AS INT)) = 0""")
def unconfirmed_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agenda.unconfirmed(table(spark, sf_dir, "orders"), "o_custkey", F.col("o_orderpriority") == "1-URGENT")


@query("""SELECT o_custkey, max(CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END) AS weight, CAST(least(count(*), 3) AS BIGINT) AS bonus, CAST(min(o_orderdate) AS DATE) AS first FROM orders GROUP BY o_custkey ORDER BY weight DESC, bonus DESC, first, o_custkey LIMIT 50""", days=("first",))
def gap_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report: the limit is the feature."""
    rows = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return agenda.gaps(rows, "o_custkey", F.when(F.col("o_orderstatus") == "P", 2).otherwise(1), "day", 50)


@query("""SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(lower(p_name || ' ' || p_type), ' '))), ' ') AS key FROM part""")
def festival_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.concat_ws(" ", "p_name", "p_type", F.lit("XII Festival de 2026"))
    common = F.array(F.lit("festival"), F.lit("de"))
    return table(spark, sf_dir, "part").select("p_partkey", names.festival_key(title, common).alias("key"))
