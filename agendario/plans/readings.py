"""Queries of reading plans, trusted readings, dated titles, deep merges and upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import deep, reading
from ..sources import segments
from ..sources.tables import table
from .catalog import query

BUDGET, QUOTA = 4000.0, 150.0


@query(f"""WITH w AS (SELECT 'u' || o_custkey AS url, 'h' || o_custkey % 40 AS host, o_orderstatus <> 'F' AS filled, month(CAST(o_orderdate AS DATE)) AS month, 1 + o_custkey % 5 AS cost FROM orders),
o AS (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY url ORDER BY filled, month, host) = 1), h AS (SELECT *, sum(cost) OVER (PARTITION BY host ORDER BY filled, month, url ROWS UNBOUNDED PRECEDING) AS ends FROM o),
a AS (SELECT *, sum(cost) OVER (ORDER BY filled, month, url ROWS UNBOUNDED PRECEDING) AS total FROM h WHERE ends <= {QUOTA}) SELECT url, host, CAST(ends - cost AS DOUBLE) AS starts FROM a WHERE total <= {BUDGET}""")
def pages_within_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), F.col("o_custkey")
    wanted = o.select(F.concat(F.lit("u"), c.cast("string")).alias("url"), F.concat(F.lit("h"), (c % 40).cast("string")).alias("host"), (F.col("o_orderstatus") != "F").alias("filled"), F.month(F.to_date("o_orderdate")).alias("month"), (1 + c % 5).alias("cost"))
    return reading.schedule(wanted, F.col("cost"), ["filled", "month"], ["filled", "month"], BUDGET, QUOTA).select("url", "host", "starts")


@query("""WITH p AS (SELECT l_orderkey AS record, 'u' || l_linenumber AS url, 'h' || l_suppkey % 5 AS host, l_linenumber AS position, l_returnflag = 'R' AS official, l_orderkey % 2 = 0 AS gaps FROM lineitem),
b AS (SELECT record, arg_min(url, ROW(NOT official, position, url, host)) AS url, arg_min(host, ROW(NOT official, position, url, host)) AS host FROM p GROUP BY record),
r AS (SELECT p.record, p.host, min(ROW(p.position, p.url)) AS x FROM p JOIN b USING (record) WHERE p.gaps AND p.host <> b.host GROUP BY ALL), n AS (SELECT record, arg.url, host, n FROM (SELECT record, host, row_number() OVER (PARTITION BY record ORDER BY x, host) AS n, x FROM r), LATERAL (SELECT x[2] AS url) AS arg WHERE n < 3)
SELECT record, url, host, 0 AS n FROM b UNION ALL SELECT record, url, host, CAST(n AS INT) FROM n""")
def pages_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    return reading.chosen_pages(l.select(F.col("l_orderkey").alias("record"), F.concat(F.lit("u"), F.col("l_linenumber").cast("string")).alias("url"), F.concat(F.lit("h"), (F.col("l_suppkey") % 5).cast("string")).alias("host"), F.col("l_linenumber").alias("position"), (F.col("l_returnflag") == "R").alias("official"), (F.col("l_orderkey") % 2 == 0).alias("gaps")))


@query("""WITH r AS (SELECT l_orderkey AS record, l_returnflag AS field, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS value, l_suppkey % 20 AS host, l_linenumber AS position FROM lineitem),
t AS (SELECT l_suppkey % 20 AS host, l_returnflag AS field, round(avg(CAST(l_linestatus = 'O' AS INT)), 6) AS share FROM lineitem WHERE l_suppkey % 3 > 0 GROUP BY ALL HAVING count(*) >= 3)
SELECT record, field, x.value AS value, x.host AS host FROM (SELECT record, field, arg_min(struct_pack(value := value, host := host), ROW(-coalesce(share, -1), position, value)) AS x FROM r LEFT JOIN t USING (host, field) WHERE share IS NULL OR share >= 0.01 GROUP BY record, field)""")
def readings_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    host = (F.col("l_suppkey") % 20).alias("host")
    rows = l.select(F.col("l_orderkey").alias("record"), F.col("l_returnflag").alias("field"), F.col("l_quantity").cast("int").cast("string").alias("value"), host, F.col("l_linenumber").alias("position"))
    trust = l.where("l_suppkey % 3 > 0").groupBy(host, F.col("l_returnflag").alias("field")).agg(F.round(F.avg((F.col("l_linestatus") == "O").cast("int")), 6).alias("share"), F.count("*").alias("n")).where("n >= 3")
    return reading.trusted_readings(rows, trust, 0.01)


@query("""SELECT event_id, CAST(ts AS DATE) AS day, CASE event_id % 3 WHEN 0 THEN 'Show ' || event_type WHEN 1 THEN upper(event_type) ELSE 'After ' || event_type END AS title, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%H:%M') END AS hour FROM events WHERE event_id % 3 < 2""", days=("day",))
def titles_of_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles before their dates, in the same text or in one above; in every third page the title follows, so it isn't this date's."""
    e = table(spark, sf_dir, "events")
    d, t = F.date_format("ts", "d/M/yyyy"), F.col("event_type")
    hour = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("<i>"), F.date_format("ts", "HH:mm"), F.lit("</i>"))).otherwise("<i>Comprar</i>")
    page = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("<header>x 1/1/2020</header><h2>Show "), t, F.lit("</h2><p>***</p><b>"), d, F.lit("</b>"), hour))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("<p>Other</p><b>"), F.upper(t), F.lit(" - "), d, F.lit("</b>"), hour)).otherwise(F.concat(F.lit("<b>"), d, F.lit("</b>"), hour, F.lit("<p>After "), t, F.lit("</p>")))
    )
    found = segments.dated_titles(e.select("event_id", page.alias("html")), "event_id", "html", F.lit("2024-01-01").cast("date"), "comprar|other")
    return found.select("event_id", "day", "title", "hour")


@query("""WITH a AS (SELECT * FROM orders WHERE o_orderkey % 3 <> 0), b AS (SELECT * FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NOT NULL THEN 'their' || b.o_custkey ELSE 'our' || a.o_custkey END AS who, CASE WHEN a.o_orderkey IS NOT NULL THEN a.o_orderstatus ELSE b.o_orderpriority END AS state,
CASE WHEN a.o_orderkey IS NOT NULL THEN '1' END AS ours, CASE WHEN b.o_orderkey IS NOT NULL THEN '2' END AS theirs FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def values_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested values of two sides: one member by a rule for its path, one by the default, one of each side alone."""
    o = table(spark, sf_dir, "orders")
    key, who = F.col("o_orderkey"), F.col("o_custkey").cast("string")

    def side(name: str, state: str, only: str):
        return F.to_json(F.struct(F.struct(F.struct(F.concat(F.lit(name), who).alias("who"), F.col(state).alias("state")).alias("deep")).alias("x"), F.struct(F.lit(1 if only == "ours" else 2).alias(only)).alias("y")))

    ours = o.where(key % 3 != 0).select("o_orderkey", F.parse_json(side("our", "o_orderstatus", "ours")).alias("v"))
    theirs = o.where(key % 4 != 0).select("o_orderkey", F.parse_json(side("their", "o_orderpriority", "theirs")).alias("v"))
    merged = deep.deep_merge(ours, theirs, "o_orderkey", "v", prefer={"x.deep.who": "theirs"})
    return merged.select("o_orderkey", *[F.try_variant_get("v", path, "string").alias(n) for n, path in (("who", "$.x.deep.who"), ("state", "$.x.deep.state"), ("ours", "$.y.ours"), ("theirs", "$.y.theirs"))])


@query("""WITH s AS (SELECT o_custkey AS k, any_value(c_name) AS name, min(o_orderstatus) AS status FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 2 = 0 GROUP BY ALL),
m AS (SELECT o_custkey AS k, min(o_orderstatus) AS status FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey), b AS (SELECT k, CASE WHEN k % 7 > 0 THEN status END AS status FROM m), a AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 5 > 0)
SELECT coalesce(s.k, b.k, a.k) AS k, CASE WHEN b.k IS NULL THEN 'unanswered' WHEN a.k IS NULL THEN 'unasked' WHEN b.status IS NULL THEN 'empty' WHEN s.k IS NOT NULL AND s.status IS NOT DISTINCT FROM b.status THEN 'same' WHEN s.k IS NULL THEN 'inserted' ELSE 'updated' END AS outcome
FROM s FULL JOIN b ON s.k = b.k FULL JOIN a ON a.k = coalesce(s.k, b.k) WHERE b.k IS NOT NULL OR a.k IS NOT NULL""")
def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    status = F.min("o_orderstatus").alias("status")
    stored = o.where("o_orderkey % 2 = 0").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi").groupBy(F.col("o_custkey").alias("k")).agg(status).withColumn("stamp", F.lit("d0"))
    batch = o.where("o_orderkey % 3 = 0").groupBy(F.col("o_custkey").alias("k")).agg(status).withColumn("status", F.when(F.col("k") % 7 > 0, F.col("status")))
    asked = c.where("c_custkey % 5 > 0").select(F.col("c_custkey").alias("k"))
    return deep.upsert(stored, batch, asked, "k", ["status"], F.lit("d1"))[1].select("k", "outcome")


@query("""WITH o AS (SELECT o_custkey % 300 AS cluster_id, o_orderkey AS row_id, o_orderkey % 3 AS priority, CASE WHEN o_orderkey % 4 = 0 THEN [md5('a' || o_custkey % 11), md5('b' || o_orderkey % 5)] WHEN o_orderkey % 4 = 1 THEN [md5('a' || o_custkey % 11)] ELSE [md5('c' || o_orderkey % 4)] END AS names FROM orders WHERE o_orderkey % 6 < 5),
e AS (SELECT cluster_id, priority, row_id, unnest(names) AS name, generate_subscripts(names, 1) AS n FROM o), f AS (SELECT cluster_id, name, min(ROW(priority, row_id, n)) AS place FROM e GROUP BY ALL)
SELECT cluster_id, 'Fest ' || cluster_id AS festival, string_agg(name, ',' ORDER BY place) AS artists FROM f GROUP BY cluster_id""")
def festival_line_ups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-ups out of titles with lists and of names beside titles; the names are only like themselves."""
    from ..operators import lineups
    from ..operators.matching import Rules

    o = table(spark, sf_dir, "orders").where("o_orderkey % 6 < 5")
    k, c = F.col("o_orderkey"), F.col("o_custkey")

    def code(letter: str, number):
        return F.md5(F.concat(F.lit(letter), number.cast("string")))

    title = F.concat(F.lit("Fest "), (c % 300).cast("string"))
    names = (
        F.when(k % 4 == 0, F.array(F.concat(title, F.lit(" ("), code("a", c % 11), F.lit(", "), code("b", k % 5), F.lit(")")))).when(k % 4 == 1, F.array(F.concat(title, F.lit(": "), code("a", c % 11)))).otherwise(F.array(title, code("c", k % 4)))
    )
    found = lineups.line_ups(o.select((c % 300).alias("cluster_id"), k.alias("row_id"), (k % 3).cast("int").alias("priority"), names.alias("names"), F.lit(None).cast("boolean").alias("festival")), Rules())
    return found.select("cluster_id", "festival", F.array_join("artists", ",").alias("artists"))
