"""Queries of the consolidation steps, over listings made from ``lineitem``, ``part`` and ``supplier``.

A line is an announcement: shipped on the day, of the part by name and brand, at a venue of the supplier, by the source of its
line number. Sources 1 to 3 are official, ticketing and an agenda; the others are agendas of less weight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cluster, consolidate
from ..operators.matching import Rules
from ..sources.tables import table
from .catalog import _NORM, query

SOURCES = [(1, 1, "a", "Madrid"), (2, 2, "b", None), (3, 3, "c", None), (4, 3, "c", "Getafe"), (5, 4, "d", None), (6, 4, "e", None), (7, 4, "f", None)]
TOWNS = [("madrid", "Madrid"), ("getafe", "Getafe"), ("alcala", "Alcalá"), ("alcala de henares", "Alcalá")]
CITIES = ["Madrid", "Getafe (Madrid)", "Alcalá de Henares", "Toledo", ""]
VENUES = [(f"sala {k}", "Madrid" if k % 2 else "Getafe") for k in range(0, 40, 3)]
FIRST, LAST = "1996-01-01", "1996-06-30"

_ROW = "((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 100 + CAST(l_quantity AS INT)"
_NAME = "CASE l_quantity % 9 WHEN 0 THEN upper(p_name) || ' ' || p_brand WHEN 1 THEN 'y más ' || p_name WHEN 2 THEN p_name || 'Ã³ ' || p_brand ELSE p_name || ' ' || p_brand END"
_CITY = "CASE l_orderkey % 5 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(CITIES)) + " END"
_VENUE = "CASE l_suppkey % 11 WHEN 0 THEN '' WHEN 1 THEN upper('Sala ' || (l_suppkey % 40)) ELSE 'Sala ' || (l_suppkey % 40) END"


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")  # noqa: E741
    rows = l.join(p, l["l_partkey"] == p["p_partkey"])
    return rows.select(
        F.expr(_ROW).alias("row_id"), F.to_date("l_shipdate").alias("day"), F.expr(_NAME).alias("name"), F.array().cast("array<string>").alias("guests"), F.expr(_VENUE).alias("venue"), F.expr(_CITY).alias("city"),
        (1200 + 30 * (F.col("l_quantity").cast("int") % 4)).alias("minutes"), F.col("l_extendedprice").cast("string").alias("price"), F.concat(F.lit("http://s/"), F.col("l_orderkey").cast("string")).alias("url"), F.col("l_linenumber").cast("int").alias("source"),
    )


_L = f"""l AS (SELECT {_ROW} AS row_id, CAST(l_shipdate AS DATE) AS day, {_NAME} AS name, {_VENUE} AS venue, {_CITY} AS city, 1200 + 30 * (CAST(l_quantity AS INT) % 4) AS minutes, l_linenumber AS source FROM lineitem JOIN part ON l_partkey = p_partkey),
s(source, priority, grp, source_town) AS (VALUES {", ".join(f"({a}, {b}, '{c}', {'NULL' if d is None else repr(d)})" for a, b, c, d in SOURCES)}), v(venue_key, venue_town) AS (VALUES {", ".join(str(v) for v in VENUES)})"""


def _n(x: str) -> str:
    return _NORM.replace("TEXT", x)


_PREPARED = f"""{_L}, p AS (SELECT l.*, priority, grp, {_n('venue')} AS venue_key, source_town, CASE WHEN city LIKE 'Madrid%' THEN 'Madrid' WHEN city LIKE 'Getafe%' THEN 'Getafe' WHEN city LIKE 'Alcal%' THEN 'Alcalá' END AS city_town FROM l JOIN s USING (source)),
t AS (SELECT p.*, CASE WHEN city = '' OR city_town IS NOT NULL THEN coalesce(venue_town, city_town, source_town) END AS town, regexp_matches(name, 'Ã³') AS broken FROM p LEFT JOIN v USING (venue_key)),
r AS (SELECT *, CASE WHEN starts_with({_n('name')} || ' ', 'y mas ') THEN 'no name' WHEN day < DATE '{FIRST}' OR day > DATE '{LAST}' THEN 'day' WHEN town IS NULL THEN 'town' END AS reason FROM t),
e AS (SELECT *, max(CAST(NOT broken AND reason IS NULL AS INT)) OVER (PARTITION BY day, town) AS clean FROM r),
k AS (SELECT * REPLACE (CASE WHEN reason IS NULL AND broken AND clean = 1 THEN 'encoding' ELSE reason END AS reason) FROM e)"""


def _prepared(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    sources = spark.createDataFrame(SOURCES, "source int, priority int, grp string, town string")
    towns, venues = spark.createDataFrame(TOWNS, "alias string, town string"), spark.createDataFrame(VENUES, "venue_key string, town string")
    first, last = (F.lit(d).cast("date") for d in (FIRST, LAST))
    return consolidate.prepare(listings(spark, sf_dir), sources, towns, venues, first, last, ("y mas",))


@query(f"""WITH {_PREPARED}, n AS (SELECT venue_key, venue, count(*) AS n FROM k WHERE reason IS NULL AND venue_key <> '' GROUP BY ALL),
b AS (SELECT venue_key, venue AS spelling FROM (SELECT *, row_number() OVER (PARTITION BY venue_key ORDER BY CASE WHEN upper(venue) <> venue THEN 1 ELSE 0 END DESC, n DESC, venue) AS r FROM n) WHERE r = 1)
SELECT row_id, town, coalesce(spelling, venue) AS venue FROM k LEFT JOIN b USING (venue_key) WHERE reason IS NULL""")
def rows_in_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir)[0].select("row_id", "town", "venue")


@query(f"""WITH {_PREPARED} SELECT source, reason, count(*) AS n FROM k WHERE reason IS NOT NULL GROUP BY ALL""")
def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir)[1]


RULES = Rules(kinds=frozenset(["sala", "club"]), common=frozenset(["brand", "the", "red", "blue"]))


@query()
def day_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announcements in scope of one day that are of one event (tested against first-fit over whole days)."""
    from ..functions.text import norm_key

    kept = _prepared(spark, sf_dir)[0]
    rows = kept.select("day", "row_id", F.array(norm_key(F.col("name"))).alias("names"), F.regexp_replace("venue_key", "^sala ", "").alias("venue"), "priority", "minutes")
    return cluster.clusters(rows, ["day"], RULES)


@query("""SELECT o_orderkey AS row_id, min(o_orderkey) OVER (PARTITION BY o_orderdate, o_custkey % 40, o_custkey % 7) AS cluster_id FROM orders""")
def exact_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and venues that are only like themselves: the clusters are those of equal day, name and venue."""
    o = table(spark, sf_dir, "orders")
    names = F.array(F.md5(F.concat(F.lit("n"), (F.col("o_custkey") % 40).cast("string"))))
    rows = o.select(F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("row_id"), names.alias("names"), F.md5(F.concat(F.lit("v"), (F.col("o_custkey") % 7).cast("string"))).alias("venue"), (F.col("o_orderkey") % 3).cast("int").alias("priority"), F.lit(None).cast("int").alias("minutes"))
    return cluster.clusters(rows, ["day"], RULES)


@query()
def consolidate_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: scope, cleaning, clusters, resolution, venue conflicts (tested on small listings with known results)."""
    events = consolidate.merge_venues(consolidate.records(_prepared(spark, sf_dir)[0], RULES))
    return events.select("event_id", F.col("day").cast("string").alias("day"), "artist", F.array_join("guests", "|").alias("guests"), "venue", "minutes", "price", F.size("sources").alias("n_sources"), F.array_join("conflicts", "|").alias("conflicts"), "state")


_E = """e AS (SELECT o_orderkey AS event_id, CAST(o_orderdate AS DATE) AS day, 'artist ' || (o_custkey % 50) AS artist, 'sala ' || (o_custkey % 9) AS venue, o_orderstatus AS source FROM orders),
u AS (SELECT * FROM e QUALIFY count(*) OVER (PARTITION BY day, artist, venue) = 1), b AS (SELECT * FROM u WHERE event_id % 5 <> 0),
c AS (SELECT * REPLACE (CASE WHEN event_id % 7 = 0 THEN day + 3 ELSE day END AS day, CASE WHEN event_id % 11 = 0 THEN artist || ' en gira' ELSE artist END AS artist) FROM u WHERE event_id % 4 <> 0)"""


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from pyspark.sql import Window

    e = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.to_date("o_orderdate").alias("day"), F.concat(F.lit("artist "), (F.col("o_custkey") % 50).cast("string")).alias("artist"),
        F.concat(F.lit("sala "), (F.col("o_custkey") % 9).cast("string")).alias("venue"), F.array(F.struct(F.lit(1).alias("priority"), F.col("o_orderstatus").alias("source"))).alias("sources"),
    )
    u = e.withColumn("n", F.count("*").over(Window.partitionBy("day", "artist", "venue"))).where("n = 1").drop("n")
    now = u.where("event_id % 4 <> 0").withColumns({
        "day": F.when(F.col("event_id") % 7 == 0, F.date_add("day", 3)).otherwise(F.col("day")),
        "artist": F.when(F.col("event_id") % 11 == 0, F.concat("artist", F.lit(" en gira"))).otherwise(F.col("artist")),
    })
    return now, u.where("event_id % 5 <> 0")


@query(f"""WITH {_E}, s0 AS (SELECT c.event_id AS id, min(b.event_id) AS old_id FROM c JOIN b USING (day, artist, venue) GROUP BY c.event_id), s AS (SELECT min(id) AS id, old_id FROM s0 GROUP BY old_id),
c1 AS (SELECT * FROM c WHERE event_id NOT IN (SELECT id FROM s)), b1 AS (SELECT * FROM b WHERE event_id NOT IN (SELECT old_id FROM s)),
p AS (SELECT c1.event_id AS id, b1.event_id AS old_id FROM c1 JOIN b1 USING (day, venue) WHERE c1.artist = b1.artist OR c1.artist = b1.artist || ' en gira'
  OR (c1.artist NOT LIKE '%gira' AND len(c1.artist) = len(b1.artist) AND FALSE)),
n AS (SELECT id, old_id FROM (SELECT *, count(*) OVER (PARTITION BY id) AS x, count(*) OVER (PARTITION BY old_id) AS y FROM p) WHERE x = 1 AND y = 1),
c2 AS (SELECT * FROM c1 WHERE event_id NOT IN (SELECT id FROM n)), b2 AS (SELECT * FROM b1 WHERE event_id NOT IN (SELECT old_id FROM n)),
q AS (SELECT c2.event_id AS id, b2.event_id AS old_id FROM c2 JOIN b2 USING (artist, venue) WHERE abs(c2.day - b2.day) <= 30),
m AS (SELECT id, old_id FROM (SELECT *, count(*) OVER (PARTITION BY id) AS x, count(*) OVER (PARTITION BY old_id) AS y FROM q) WHERE x = 1 AND y = 1)
SELECT id, old_id, 'kept' AS state FROM s UNION ALL SELECT id, old_id, 'renamed' FROM n UNION ALL SELECT id, old_id, 'moved' FROM m
UNION ALL SELECT event_id, NULL, 'new' FROM c2 WHERE event_id NOT IN (SELECT id FROM m)
UNION ALL SELECT NULL, event_id, CASE WHEN day < DATE '1996-01-01' THEN 'past' WHEN source = 'F' THEN 'possibly_cancelled' ELSE 'carried' END FROM b2 WHERE event_id NOT IN (SELECT old_id FROM m)""")
def reconcile_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, was = _runs(spark, sf_dir)
    complete = spark.createDataFrame([("F", True), ("O", False)], "source string, complete boolean")
    return consolidate.reconcile(now, was, complete, F.lit("1996-01-01").cast("date"), Rules(least_name=99.0))
