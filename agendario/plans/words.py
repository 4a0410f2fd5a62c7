"""Queries of the field functions, over titles made from ``part``, over ``pages``, ``events`` and ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, fields, names, text
from ..sources.tables import table
from .catalog import _NORM, query

#: The same expression in Spark and DuckDB: titles of many forms.
_TITLE = """CASE p_partkey % 10 WHEN 0 THEN p_name || ' + ' || p_brand WHEN 1 THEN 'Sala ' || p_name WHEN 2 THEN p_name || ' (SE)' WHEN 3 THEN p_name || ' gira en concierto'
WHEN 4 THEN 'Festival ' || p_name || ': ' || p_brand || ', ' || p_type || ' y muchos más' WHEN 5 THEN 'Tributo a ' || p_name WHEN 6 THEN upper(p_name) || ' 21:30 h 12,5 €'
WHEN 7 THEN p_name || ' - ' || p_type WHEN 8 THEN 'Ciclo ' || p_brand || '. ' || p_name ELSE 'y más ' || p_name END"""
_T = f"t AS (SELECT p_partkey AS id, p_brand AS brand, p_name AS name, p_type AS kind, p_size AS size, p_retailprice AS price, {_TITLE} AS title FROM part)"


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), F.col("p_name").alias("name"), F.col("p_type").alias("kind"), F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"), F.expr(_TITLE).alias("title")
    )


def _n(x: str) -> str:
    return _NORM.replace("TEXT", x)


def _has(key: str, phrases: tuple[str, ...], anchor: bool = False) -> str:
    f = "starts_with" if anchor else "contains"
    return "(" + " OR ".join(f"{f}(' ' || {key} || ' ', ' {p} ')" for p in phrases) + ")"


FILLER, GENERIC, TURNS, KINDS, COMMON = ("y mas", "otros", "tba"), ("widget", "banda"), ("gira", "presenta", "tour"), ("sala", "club", "teatro"), ("red", "the", "brand")


@query(f"""WITH {_T}, k AS (SELECT *, {_n('title')} AS k, {_n('name')} AS n FROM t)
SELECT id, k = '' OR {_has('k', FILLER, True)} AS filler, n IN ('widget', 'banda') OR length(n) < 3 AS generic, regexp_matches(regexp_replace(title, '\\([^)]*\\)', ' ', 'g'), '(?i)(^|[^a-z])fest(ival)?([^a-z]|$)') AS festival,
{_has('k', ('tributo', 'homenaje'))} AS tribute, {_has('k', ('gira', 'ciclo'))} AS unfocused, length(k) BETWEEN 3 AND 60 AND regexp_matches(k, '[a-z]') AS asked FROM k""")
def title_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, key = F.col("title"), text.norm_key(F.col("title"))
    return titles(spark, sf_dir).select(
        "id", fields.is_filler(t, FILLER).alias("filler"), fields.is_generic(F.col("name"), GENERIC).alias("generic"), names.is_festival(t).alias("festival"),
        fields.has_phrase(key, ("tributo", "homenaje")).alias("tribute"), fields.has_phrase(key, ("gira", "ciclo")).alias("unfocused"), fields.worth_asking(t).alias("asked"),
    )


_HEAD = "CASE WHEN trim(regexp_extract(' ' || k || ' ', '^(.*?) (?:gira|presenta|tour) ', 1)) <> '' THEN trim(regexp_extract(' ' || k || ' ', '^(.*?) (?:gira|presenta|tour) ', 1)) ELSE k END"
_CYCLE = "trim(regexp_extract(title, '^([^.:]{4,}?)[.:] +[^ ]', 1))"


@query(f"""WITH {_T}, k AS (SELECT *, {_n('title')} AS k FROM t), h AS (SELECT *, {_HEAD} AS head, {_CYCLE} AS c FROM k)
SELECT id, head, array_to_string(list_sort(list_distinct(list_filter([k, head, regexp_replace(k, '^(the|los|las|el|la) ', ''), replace(k, ' ', '')], lambda x: x <> ''))), '|') AS variants,
nullif(c, '') AS cycle, CASE WHEN c <> '' THEN trim(regexp_replace(title, '^[^.:]{{4,}}?[.:] +', '')) ELSE title END AS rest, trim(string_split(title, ' - ')[-1]) AS performer,
array_to_string(list_filter(string_split(k, ' '), lambda w, i: length(w) >= 3 AND w NOT IN ('red', 'the', 'brand') AND NOT regexp_matches(w, '^[0-9]+$') AND list_position(string_split(k, ' '), w) = i), ' ') AS significant,
array_to_string(list_filter(list_transform(string_split_regex(title, '[,/;|·]| - '), lambda x: trim(x)), lambda x: x <> ''), '|') AS parts FROM h""")
def title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    cycle, rest = fields.without_cycle(t)
    return titles(spark, sf_dir).select(
        "id", fields.head(t, TURNS).alias("head"), F.array_join(fields.variants(t, TURNS), "|").alias("variants"), cycle.alias("cycle"), rest.alias("rest"),
        fields.performer(t).alias("performer"), F.array_join(fields.significant(t, COMMON), " ").alias("significant"), F.array_join(fields.style_parts(t), "|").alias("parts"),
    )


@query(f"""WITH {_T}, k AS (SELECT *, {_n('title')} AS k, {_CYCLE} AS c FROM t), h AS (SELECT *, {_HEAD} AS head, CASE WHEN c <> '' THEN trim(regexp_replace(title, '^[^.:]{{4,}}?[.:] +', '')) ELSE title END AS rest, trim(string_split(title, ' - ')[-1]) AS p FROM k),
x AS (SELECT id, [k, {_n('rest')}, {_n('p')}, head] AS l FROM h), e AS (SELECT id, unnest(l) AS key, generate_subscripts(l, 1) AS pos FROM x), d AS (SELECT id, key, min(pos) AS pos FROM e WHERE key <> '' GROUP BY ALL)
SELECT id, key, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INT) AS pos FROM d""")
def card_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select("id", F.posexplode(fields.card_keys(F.col("title"), TURNS)).alias("pos", "key"))


@query(f"""WITH {_T}, p AS (SELECT id, title, list_filter(list_transform(string_split_regex(regexp_replace(title, '^[^:]*:', ''), ',|\\+| y '), lambda x: trim(x)), lambda x: x <> '') AS l, regexp_matches(title, '(?i)^[^:]*\\bfest(ival)?\\b[^:]*:') AS c FROM t),
a AS (SELECT *, list_filter(l, lambda x: NOT starts_with({_n('x')} || ' ', 'muchos mas ')) AS a FROM p)
SELECT id, CASE WHEN c THEN trim(string_split(title, ':')[1]) END AS festival, CASE WHEN c THEN array_to_string(a, '|') ELSE '' END AS artists, c AND len(a) < len(l) AS incomplete FROM a""")
def line_ups(spark: SparkSession, sf_dir: str) -> DataFrame:
    festival, artists, incomplete = names.line_up(F.col("title"), F.array(F.lit("muchos mas")))
    return titles(spark, sf_dir).select("id", festival.alias("festival"), F.array_join(artists, "|").alias("artists"), incomplete.alias("incomplete"))


@query(f"""WITH {_T} SELECT id, regexp_replace({_n('title')}, '^(?:sala|club|teatro) ', '') AS venue, array_to_string(list_filter(string_split({_n('title')}, ' '), lambda w: w <> '' AND w NOT IN ('sala', 'club', 'teatro')), ' ') AS venue_words,
nullif(regexp_extract(title, '\\(([A-Z]{{2}})\\)', 1), '') AS country, nullif(CASE WHEN starts_with(title, 'Tributo a ') THEN substr(title, 11) ELSE '' END, '') AS honoured,
CASE WHEN title LIKE '%21:30 h%' THEN '21:30' END AS hour, CASE WHEN title LIKE '%12,5 €%' THEN '12,5 €' END AS price, title LIKE '%12,5 €%' AS price_named, title LIKE '%21:30%' AS hour_named FROM t""")
def title_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return titles(spark, sf_dir).select(
        "id", fields.venue_key(t, KINDS).alias("venue"), fields.venue_words(t, KINDS).alias("venue_words"), names.only_country(t, ("SE", "NO")).alias("country"), names.honoured(t).alias("honoured"),
        dates.parse_hour(t).alias("hour"), fields.clear_price(t).alias("price"), fields.price_named(t, F.lit(12.5)).alias("price_named"), dates.hour_named(t, F.lit("21:30")).alias("hour_named"),
    )


@query("""SELECT event_id, CASE WHEN value > 0 AND value < 2000 THEN CAST(value AS DOUBLE) END AS amount,
replace(regexp_replace(regexp_replace(printf('%.2f', value), '0+$', ''), '\\.$', ''), '.', ',') || ' €' AS euros,
CASE WHEN n >= 1000000 THEN '1M+' WHEN n >= 100000 THEN '100k+' WHEN n >= 10000 THEN '10k+' WHEN n >= 0 THEN '<10k' END AS label,
CASE WHEN n >= 1000000 THEN replace(printf('%.1f', (n // 100000) / 10), '.', ',') || ' M' WHEN n >= 10000 THEN CAST(n // 1000 AS VARCHAR) || ' k' ELSE CAST(n AS VARCHAR) END AS listeners,
bit_count(xor(event_id * 2654435761, user_id * 40503)) <= 20 AS same_picture,
CASE WHEN event_type = 'error' THEN 'cancelled' WHEN event_type = 'click' THEN 'postponed' END AS state, event_type IN ('view', 'error') AS sold_out
FROM (SELECT *, user_id * event_id * 97 AS n FROM events)""")
def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "https://schema.org/EventCancelled").when(F.col("event_type") == "click", "EventRescheduled").otherwise("EventScheduled")
    offers = F.when(F.col("event_type").isin("view", "error"), F.array(F.lit("SoldOut"), F.lit("http://schema.org/SoldOut"))).when(F.col("event_type") == "click", F.array(F.lit("SoldOut"), F.lit("InStock"))).otherwise(F.array().cast("array<string>"))
    state, sold_out = fields.event_state(status, offers)
    n = F.col("user_id") * F.col("event_id") * 97
    same = fields.same_picture(F.col("event_id") * F.lit(2654435761), F.col("user_id") * 40503)
    return table(spark, sf_dir, "events").select(
        "event_id", fields.amount(F.col("value")).alias("amount"), fields.euros(F.col("value")).alias("euros"), fields.listeners_label(n).alias("label"), fields.listeners_text(n).alias("listeners"), same.alias("same_picture"), state.alias("state"), sold_out.alias("sold_out")
    )


@query("""WITH h AS (SELECT event_id, user_id, strftime(ts, '%H:%M') AS h, lag(strftime(ts, '%H:%M')) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events)
SELECT event_id, coalesce(abs((CAST(left(h, 2) AS INT) * 60 + CAST(right(h, 2) AS INT)) - (CAST(left(b, 2) AS INT) * 60 + CAST(right(b, 2) AS INT))) > 120, false) AS far FROM h""")
def far_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    hour = F.date_format("ts", "HH:mm")
    before = F.lag(hour).over(Window.partitionBy("user_id").orderBy("event_id"))
    return table(spark, sf_dir, "events").select("event_id", hour.alias("h"), before.alias("b")).select("event_id", fields.far_apart(F.col("h"), F.col("b")).alias("far"))


_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query(f"""WITH p AS (SELECT page_id, url, {_PATH} AS path FROM pages), s AS (SELECT *, list_filter(string_split({_n("regexp_replace(regexp_extract(regexp_replace(path, '/+$', ''), '([^/]*)$', 1), '\\.[a-z]{2,5}$', '')")}, ' '), lambda w: w <> '') AS w FROM p)
SELECT page_id, path NOT IN ('', '/') AS specific, array_to_string(w, ' ') AS slug, len(list_filter(w, lambda x: contains(x, '619'))) > 0 AS mentions, len(w) >= 2 AND len(list_filter(w, lambda x: contains(x, '619'))) = 0 AS other,
left(sha1(url), 16) AS file, 'https://img/' || left(md5(url), 1) || '/' || left(md5(url), 2) || '/' || url || '/320px-' || url AS thumbnail FROM s""")
def url_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", fields.is_specific(u).alias("specific"), F.array_join(fields.slug_words(u), " ").alias("slug"), fields.mentions_artist(u, F.lit("619 x")).alias("mentions"), fields.of_another_event(u, F.lit("619 x")).alias("other"),
        fields.file_name(u).alias("file"), fields.thumbnail_url("https://img/", u, 320).alias("thumbnail"),
    )


@query(f"""WITH {_T} SELECT id, left(sha1('2026-05-01|' || {_n('brand')} || '|' || {_n('title')}), 12) AS event_id, left(replace({_n('title')}, ' ', '-'), 60) AS slug FROM t""")
def event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titles(spark, sf_dir).select("id", fields.event_id(F.lit("2026-05-01").cast("date"), F.col("brand"), F.col("title")).alias("event_id"), text.slug(F.col("title")).alias("slug"))


DEMONYMS = {"the": "GB", "que": "ES", "und": "DE", "les": "FR"}
_LISTED = ", ".join(f"'{w}'" for w in DEMONYMS)
_CODES = "CASE w " + " ".join(f"WHEN '{w}' THEN '{c}'" for w, c in DEMONYMS.items()) + " END"


@query(f"""WITH s AS (SELECT doc_id, unnest(string_split_regex(text, '[.!?\n]+')) AS s FROM documents), k AS (SELECT doc_id, {_n('s')} AS k FROM s), m AS (SELECT doc_id, unnest(string_split(k, ' ')) AS w FROM k WHERE contains(' ' || k || ' ', ' de ')),
c AS (SELECT doc_id, count(DISTINCT {_CODES}) AS n, min({_CODES}) AS code FROM m WHERE w IN ({_LISTED}) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN n = 1 THEN code END AS country FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id""")
def country_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", fields.country_in_text(F.col("text"), F.lit("de"), DEMONYMS).alias("country"))


STYLES = ("of the", "the", "que", "de la", "la", "und")


@query(f"""WITH k AS (SELECT doc_id, ' ' || {_n('text')} || ' ' AS k FROM documents), f AS (SELECT doc_id, list_filter(['of the', 'de la', 'que', 'the', 'und', 'la'], lambda s: contains(k, ' ' || s || ' ')) AS f FROM k)
SELECT doc_id, array_to_string((list_filter(f, lambda s: NOT (s = 'the' AND list_contains(f, 'of the')) AND NOT (s = 'la' AND list_contains(f, 'de la'))))[1:5], '|') AS styles FROM f""")
def styles_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(fields.styles_in_text(F.col("text"), STYLES), "|").alias("styles"))


@query(f"""WITH {_T} SELECT id, CASE WHEN regexp_matches(title, '[A-Z]') AND (len(list_intersect(string_split({_n('title')}, ' '), ['gira', 'ciclo', 'tributo', 'mas'])) > 0 OR regexp_matches(lower(title), '[ñáéíóú]')) AND len(list_intersect(string_split({_n('title')}, ' '), ['red', 'blue'])) <= len(list_intersect(string_split({_n('title')}, ' '), ['gira', 'ciclo', 'tributo', 'mas'])) THEN 'ES'
WHEN (len(list_intersect(string_split({_n('title')}, ' '), ['gira', 'ciclo', 'tributo', 'mas'])) > 0 OR regexp_matches(lower(title), '[ñáéíóú]')) AND len(list_intersect(string_split({_n('title')}, ' '), ['red', 'blue'])) <= len(list_intersect(string_split({_n('title')}, ' '), ['gira', 'ciclo', 'tributo', 'mas'])) THEN 'ES' END AS estimated,
{_n("regexp_replace(regexp_replace(title, '[\\[(][^\\])]*[\\])]', ' ', 'g'), '(?i) - .*(edition|remaster|version).*$', '')")} AS album FROM t""")
def name_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return titles(spark, sf_dir).select("id", fields.estimated_country(t, ("gira", "ciclo", "tributo", "mas"), ("red", "blue"), "ES").alias("estimated"), fields.album_title(t).alias("album"))


@query("""WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders)
SELECT o_orderkey, CAST(date_diff('month', day, day + INTERVAL 100 DAYS) + 1 AS INT) AS n_months, CAST(date_diff('week', date_trunc('week', day), date_trunc('week', day + INTERVAL 100 DAYS)) + 1 AS INT) AS n_weeks FROM d""")
def windows_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    end = F.date_add(day, 100)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.size(dates.months_between(day, end)).alias("n_months"), F.size(dates.weeks_between(day, end)).alias("n_weeks"))
