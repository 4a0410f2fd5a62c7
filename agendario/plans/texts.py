"""Queries of names, phrases, claims and dates in running text, and of change histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, propernames
from ..operators import dictionary, history, positions
from ..sources.tables import table, written
from .catalog import _NORM, query

_N = _NORM.replace("TEXT", "text")

#: A sentence of a part's two words: the second is the name, with something capitalised or not on either side of it.
_PART = "upper(left(split_part(p_name, ' ', {0}), 1)) || substr(split_part(p_name, ' ', {0}), 2)"
_SENTENCE = f"""CASE p_partkey % 5 WHEN 0 THEN 'Hoy ' WHEN 1 THEN 'de la ' WHEN 2 THEN 'vuelve ' ELSE '' END || CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 1) ELSE {_PART.format(1)} END
|| CASE p_partkey % 4 WHEN 0 THEN ' de ' WHEN 1 THEN ' y la ' WHEN 2 THEN ' ' ELSE ' canta ' END || {_PART.format(2)} || CASE p_size % 4 WHEN 0 THEN '' WHEN 1 THEN ' y Otro' WHEN 2 THEN ' de noche' ELSE ' en Madrid' END"""


@query(f"""WITH s AS (SELECT p_partkey, {_SENTENCE} AS t, {_PART.format(2)} AS n FROM part)
SELECT p_partkey, NOT regexp_matches(t, '(^| )[A-Z0-9][^ ]*( (de|la|y))* ' || n || '( |$)') AND NOT regexp_matches(t, '^[a-z]+( (de|la|y))* ' || n || '( |$)' ) AND NOT regexp_matches(t, '^(de|la|y)( (de|la|y))* ' || n || '( |$)') AND NOT regexp_matches(t, n || '( (de|la|y))* [A-Z0-9]')
OR (regexp_matches(t, '^[a-z]+ ' || n || '( |$)') AND NOT regexp_matches(t, '^(de|la|y) ' || n) AND NOT regexp_matches(t, n || '( (de|la|y))* [A-Z0-9]'))
OR (regexp_matches(t, '^[a-z]+( (de|la|y))+ ' || n || '( |$)') AND NOT regexp_matches(t, '^(de|la|y)( (de|la|y))* ' || n) AND NOT regexp_matches(t, n || '( (de|la|y))* [A-Z0-9]')) AS whole FROM s""")
def names_stand_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.expr(_SENTENCE).alias("t"), F.expr(_PART.format(2)).alias("n"))
    return part.select("p_partkey", propernames.named_whole(F.col("t"), F.col("n")).alias("whole"))


_WHO, _FROM = ("grupo", "banda", "duo"), ("madrileno", "argentino", "sueco")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN '' ELSE ['madrileno', 'argentino', 'sueco'][1 + p_size % 3] END AS said, CASE WHEN p_partkey % 4 = 3 THEN 'lima' END AS place FROM part""")
def origins_said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sentence says right beside a name; in every fourth it says it of someone else, and where the name is from."""
    word = F.element_at(F.array(F.lit("madrileño"), F.lit("Argentino"), F.lit("sueco")), (1 + F.col("p_size") % 3).cast("int"))
    name = F.initcap("p_name")
    k = F.col("p_partkey") % 4
    said = (
        F.when(k == 0, F.concat(name, F.lit(" es un grupo de rock "), word, F.lit("."))).when(k == 1, F.concat(F.lit("La banda "), word, F.lit(" "), name, F.lit(" presenta disco")))
        .when(k == 2, F.concat(F.lit("el dúo de pop "), word, F.lit(" "), name)).otherwise(F.concat(name, F.lit(", nacidos en Lima, con otros. Un grupo "), word, F.lit(".")))
    )
    part = table(spark, sf_dir, "part").select("p_partkey", name.alias("n"), said.alias("s"))
    return part.select("p_partkey", F.array_join(propernames.said_beside(F.col("s"), F.col("n"), _WHO, _FROM), ",").alias("said"), propernames.birthplace_said(F.col("s"), F.col("n")).alias("place"))


_CLAIMS = f"c AS (SELECT item_id AS claim, array_to_string(k[1:2], ' ') AS name, array_to_string(k[5:6], ' ') AS phrase FROM (SELECT item_id, string_split({_N}, ' ') AS k FROM benchmark) WHERE len(k) > 5)"


@query(f"""WITH {_CLAIMS}, d AS (SELECT doc_id, string_split({_N}, ' ') AS ws FROM documents), w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
o AS (SELECT doc_id, pos, word || ' ' || lead(word) OVER v AS two, coalesce(sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beg FROM w WINDOW v AS (PARTITION BY doc_id ORDER BY pos)),
a AS (SELECT doc_id, claim, beg FROM o JOIN c ON two = name), b AS (SELECT doc_id, claim, beg, length(phrase) AS n, length(name) AS m FROM o JOIN c ON two = phrase)
SELECT doc_id, claim, CAST(min(greatest(0, b.beg - a.beg - m, a.beg - b.beg - n)) AS BIGINT) AS distance FROM a JOIN b USING (doc_id, claim) GROUP BY ALL HAVING min(greatest(0, b.beg - a.beg - m, a.beg - b.beg - n)) <= 200""")
def claims_near_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims made of benchmark items (two words as the name, two as the phrase) that documents confirm within 200 characters."""
    from ..functions.text import norm_key

    k = F.split(norm_key(F.col("text")), " ")
    claims = table(spark, sf_dir, "benchmark").where(F.size(k) > 5).select(F.col("item_id").alias("claim"), F.array_join(F.slice(k, 1, 2), " ").alias("name"), F.array_join(F.slice(k, 5, 2), " ").alias("phrase"))
    return positions.near_names(table(spark, sf_dir, "documents"), "doc_id", "text", claims, 200)


@query(f"""WITH d AS (SELECT doc_id, string_split({_N}, ' ') AS ws FROM documents), p AS (SELECT DISTINCT array_to_string(ws[1:3], ' ') AS phrase FROM d WHERE len(ws) >= 3),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d), t AS (SELECT doc_id, word || ' ' || lead(word, 1) OVER v || ' ' || lead(word, 2) OVER v AS phrase FROM w WINDOW v AS (PARTITION BY doc_id ORDER BY pos))
SELECT doc_id, phrase, count(*) AS n FROM t JOIN p USING (phrase) GROUP BY ALL""")
def opening_phrases_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the first three words of any document stand in all documents: as many phrases as documents, by windows of words."""
    docs = table(spark, sf_dir, "documents")
    phrases = written(dictionary.openings(docs, "text", 3), "openings")
    return dictionary.phrases_in(docs, "doc_id", "text", phrases, "phrase", longest=False).groupBy("doc_id", "phrase").agg(F.count("*").alias("n"))


RULES = [(1, "hot red", "both"), (2, "blue", "cold"), (3, "red", "warm"), (4, "ring", "round")]
EXACT = [("PROMO", ["offer", "cheap"]), ("large", ["big"]), ("SMALL", ["little"])]
_RULES = "r(pos, phrase, category) AS (VALUES " + ", ".join(map(str, RULES)) + ")"
_EXACT = "x(name, cats) AS (VALUES " + ", ".join(f"('{a.lower()}', {b})" for a, b in EXACT) + ")"


@query(f"""WITH {_RULES}, {_EXACT}, s AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN p_name || ' / ' || p_type WHEN 2 THEN p_type || ', ' || p_name || ';hot, red' ELSE 'hot - ' || p_name END AS said FROM part),
e AS (SELECT said, 0 AS ix, said AS piece FROM (SELECT DISTINCT said FROM s) UNION ALL SELECT said, ix, trim(piece) FROM (SELECT said, unnest(l) AS piece, generate_subscripts(l, 1) AS ix FROM (SELECT DISTINCT said, regexp_split_to_array(said, '[,/;]| - ') AS l FROM s)) WHERE trim(piece) <> ''),
k AS (SELECT said, ix, {_NORM.replace('TEXT', 'piece')} AS n FROM e), c AS (SELECT k.said, k.ix, any_value(x.cats) AS cats, arg_min(r.category, r.pos) AS word FROM k LEFT JOIN x ON x.name = k.n LEFT JOIN r ON contains(' ' || k.n || ' ', ' ' || r.phrase || ' ') GROUP BY ALL),
g AS (SELECT said, any_value(cats) FILTER (WHERE ix = 0) AS whole, any_value(word) FILTER (WHERE ix = 0) AS whole_word, list(coalesce(cats[1], word) ORDER BY ix) FILTER (WHERE ix > 0 AND coalesce(cats[1], word) IS NOT NULL) AS parts FROM c GROUP BY said),
f AS (SELECT *, coalesce(whole[1], parts[1], whole_word) AS first FROM g)
SELECT p_partkey, first AS category, coalesce(array_to_string(CASE WHEN len(whole) > 1 THEN whole WHEN first IS NULL OR list_contains(parts, first) THEN list_filter(parts, lambda v, i: list_position(parts, v) = i) ELSE list_concat([first], list_filter(parts, lambda v, i: list_position(parts, v) = i)) END, '|'), '') AS categories FROM s JOIN f USING (said)""")
def styles_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr("CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN p_name || ' / ' || p_type WHEN 2 THEN p_type || ', ' || p_name || ';hot, red' ELSE 'hot - ' || p_name END")
    exact, rules = spark.createDataFrame(EXACT, "name string, categories array<string>"), spark.createDataFrame(RULES, "pos int, phrase string, category string")
    out = dictionary.categories(table(spark, sf_dir, "part").select("p_partkey", said.alias("said")), "p_partkey", "said", exact, rules)
    return out.select("p_partkey", "category", F.array_join("categories", "|").alias("categories"))


@query(f"""WITH {_RULES} SELECT p_partkey, any_value(p_name) AS name, arg_min(category, pos) AS category FROM part LEFT JOIN r ON contains(' ' || lower(p_name) || ' ', ' ' || phrase || ' ') GROUP BY p_partkey""")
def titles_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "pos int, phrase string, category string")
    part = table(spark, sf_dir, "part")
    return dictionary.first_rule(part, "p_partkey", "p_name", rules, ["category"]).join(part.select("p_partkey", F.col("p_name").alias("name")), "p_partkey").select("p_partkey", "name", "category")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 6 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""", days=("day",))
def dates_spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of 1992 to 1998, moved by a century of four-digit years where a notation takes years from 2000 on."""
    day, k = F.add_months(F.to_date("o_orderdate"), 12 * 28), F.col("o_orderkey") % 7
    month = F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month(day))
    english = F.date_format(day, "MMM")
    said = (
        F.when(k == 0, F.date_format(day, "d.M.yyyy")).when(k == 1, F.concat_ws(" ", F.lit("Sábado"), F.dayofmonth(day), F.initcap(month), F.year(day))).when(k == 2, F.concat_ws(" ", F.dayofmonth(day), english, F.year(day)))
        .when(k == 3, F.concat(english, F.lit(" "), F.dayofmonth(day), F.lit(", "), F.year(day))).when(k == 4, F.date_format(day, "dd-MM-yy")).when(k == 5, F.concat_ws(" ", F.lit("el"), F.dayofmonth(day), F.lit("de"), month, F.lit("de"), F.year(day), F.lit("a las 21"))).otherwise("a las 21 h, 3 pases")
    )
    back = F.add_months(dates.parse_date(said, F.lit("2026-01-10").cast("date")), -12 * 28)
    return table(spark, sf_dir, "orders").select("o_orderkey", back.alias("day"))


@query()
def change_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histories of the places of ``events``, a run a day (tested against a plain fold and the stream)."""
    e = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("key"), F.to_date("ts").alias("day")).agg(
        F.min_by("event_type", "event_id").alias("place"), F.max(F.floor(F.col("value") / 50)).alias("price"), F.max(F.when(F.col("event_type") == "error", "failed")).alias("event"), F.min(F.when(F.col("event_type") == "signup", "possibly_cancelled").otherwise("ok")).alias("state"), F.collect_set(F.when(F.col("event_id") % 9 == 0, "b").otherwise("a")).alias("sources")
    )
    found = history.history(e, history.Watched(always=("place",), compared=("price",), once=("event",)))
    return found.select("key", F.posexplode("changes").alias("at", "c")).select("key", "at", F.col("c.day").cast("string").alias("day"), "c.field", "c.was", "c.now")
