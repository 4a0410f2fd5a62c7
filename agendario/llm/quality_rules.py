"""Quality rules: cross-document line frequency beside per-document counts, in column expressions.

A line (a ``\\n``-split piece with a word) is normalised (lower-cased, white space runs to one
space, trimmed) and hashed by MD5. Per host (``source``) the distinct documents with that line are
counted; a line in ``max_documents`` of them or more is boilerplate and is removed. A document of
which fewer than ``min_words`` words or less than ``min_share`` per cent remain is depleted and
rejected, as is one that fails the base rules.

Documents are distinct if their texts differ (by MD5): exact copies count once, so a group of them does
not make its own text boilerplate; near copies are different documents.

Lines are exploded and hashed once and stored. Counting runs in two steps, (host, line, text) and then
(host, line), both with partial aggregation, so a host or line with a third of all rows is spread over all tasks.

Defined cases: null text counts as empty (no words: base rules fail); a null host is a host
of its own; repeated rows and repeated ids are each returned; an empty table gives no rows;
columns other than doc_id, source and text are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, table

MAX_DOCUMENTS = 20
MIN_WORDS = 10
MIN_SHARE = 20
MAX_REPEATED = 20
WINDOW = 5

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def _replaced(text: Column, characters: str, by: str) -> Column:
    """Each of the characters replaced (by byte search, many times faster than ``translate``)."""
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _plain(text: Column) -> Column:
    """The text with one kind of white space within lines; most texts have no other and are only searched."""
    return F.when(F.rlike(text, F.lit(r"[\t\x0b\x0c\r]")), _replaced(text, "\t\x0b\x0c\r", " ")).otherwise(text)


def _words(plain: Column) -> Column:
    """The words, in order (one-character split, which the JVM does without a regex)."""
    return F.array_remove(F.split(F.replace(plain, F.lit("\n"), F.lit(" ")), " ", -1), "")


def _lines(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``normal``: the normalised ``\\n``-split lines of ``text``, blank ones as empty strings.

    The whole text is normalised before it is split, so that little is left to do per line.
    """
    lower = docs.select(*keep, F.lower("text").alias("lower"))
    plain = lower.select(*keep, _plain(F.col("lower")).alias("plain"))
    even = F.when(F.contains("plain", F.lit("  ")), F.regexp_replace("plain", " +", " ")).otherwise(F.col("plain"))
    return plain.select(*keep, F.transform(F.split(even, "\n", -1), lambda x: F.trim(x)).alias("normal"))


def _covered(positions: Column) -> Column:
    """Words in the union of the windows that start at these sorted positions."""
    gaps = F.transform(positions, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(positions, i + 1), p + WINDOW) - p))
    return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)


def _text_key() -> tuple[Column, Column]:
    """The text (null: empty) and the digest of id, source and text that tells rows apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = (F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce("source", F.lit("\x02")), text)
    return text, F.unhex(F.md5(F.concat_ws("\x01", *parts)))


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, source, key and the base counts of every row of ``docs`` (doc_id, source, text).

    ``key`` is a digest of id, source and text: rows that agree in it are repeated rows.
    """
    text, key = _text_key()
    one = docs.select("doc_id", "source", key.alias("key"), text.alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(x, F.lit(SPACES)) != "")
    one = one.withColumn("plain", _plain(F.col("text")))
    symbols = F.when(F.rlike("text", F.lit(f"[{SYMBOLS}]")), F.length("text") - F.length(_replaced(F.col("text"), SYMBOLS, ""))).otherwise(0)
    two = one.select(
        "doc_id",
        "source",
        "key",
        F.length(_replaced(F.col("plain"), " \n", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform(_words(F.col("plain")), lambda w: F.xxhash64(w)).alias("words"),
    )
    places = F.when(F.size("words") >= WINDOW, F.sequence(F.lit(0), F.size("words") - WINDOW)).otherwise(F.array().cast("array<int>"))
    three = two.select(
        "doc_id",
        "source",
        "key",
        "word_chars",
        "n_symbols",
        "lines",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform(places, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)])).alias("windows"),
    )
    # Only a text with some repeated window pays for sorting its windows with their places.
    placed = F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    four = three.withColumn("placed", placed)
    again = F.filter("placed", lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]))
    five = four.withColumn("again", F.sort_array(F.transform(again, lambda x: x["i"])))
    n_repeat = F.coalesce(_covered(F.col("again")), F.lit(0)).cast("long")
    # The counts leave through a generator: a filter on them is then applied to the counts. Pushed into the
    # expressions above, it would compute each array again for every element.
    counts = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", n_repeat.alias("n_repeat_words"))
    return five.select("doc_id", "source", "key", F.inline_outer(F.array(counts)))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: source, key, pos, line (MD5), words and document (MD5 of the whole text)."""
    text, key = _text_key()
    named = docs.select("source", key.alias("key"), text.alias("text"), F.unhex(F.md5(text)).alias("document"))
    hashed = _lines(named, "source", "key", "document").select(
        "source",
        "key",
        "document",
        F.transform(F.array_remove("normal", ""), lambda x: F.struct(F.unhex(F.md5(x)).alias("line"), (F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1).alias("words"))).alias("rows"),
    )
    return hashed.select("source", "key", "document", F.posexplode("rows").alias("pos", "row")).select("source", "key", "document", "pos", "row.line", "row.words")


def boilerplate(lines: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """(source, line) of the lines in ``max_documents`` distinct documents of a host or more."""
    apart = lines.select("source", "line", "document").distinct()
    return apart.groupBy("source", "line").agg(F.count("*").alias("n_documents")).where(F.col("n_documents") >= max_documents)


def assess(docs: DataFrame, max_documents: int = MAX_DOCUMENTS, min_words: int = MIN_WORDS, min_share: int = MIN_SHARE) -> DataFrame:
    """The counts of every row of ``docs`` with removed_words, base_failed and kept."""
    lines = stored(line_rows(docs), "lines")
    common = boilerplate(lines, max_documents).select(F.col("source").alias("at"), F.col("line").alias("what"))
    removed = (
        lines.join(common, F.col("source").eqNullSafe(F.col("at")) & (F.col("line") == F.col("what")))
        .groupBy("key", "pos")
        .agg(F.max("words").alias("words"))
        .groupBy("key")
        .agg(F.sum("words").cast("long").alias("removed"))
    )
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return (
        measures(docs)
        .join(removed, "key", "left")
        .withColumn("removed_words", F.coalesce("removed", F.lit(0).cast("long")))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= min_words) & (100 * left >= min_share * F.col("n_words")))
        .drop("removed")
    )


def cleaned(docs: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """doc_id and text of every row without its boilerplate lines; the other lines stay as they are, in order."""
    lines = stored(line_rows(docs), "lines")
    common = boilerplate(lines, max_documents).select(F.col("source").alias("at"), F.col("line").alias("what"))
    gone = (
        lines.join(common, F.col("source").eqNullSafe(F.col("at")) & (F.col("line") == F.col("what")))
        .groupBy("key")
        .agg(F.collect_set("line").alias("gone"))
    )
    text, key = _text_key()
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("gone", F.unhex(F.md5(F.get("normal", i)))))
    return (
        _lines(docs.select("doc_id", text.alias("text"), key.alias("key")), "doc_id", "text", "key")
        .join(gone, "key", "left")
        .select("doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))
    )


COLUMNS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assess(table(spark, sf_dir, "documents")).select(*COLUMNS)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    text, key = _text_key()
    rejected = assess(docs).where(~F.col("kept")).select(F.col("key").alias("rejected_key")).distinct()
    return docs.join(rejected, key == rejected["rejected_key"], "left_anti")


_WS = "[ \\t\\n\\x0b\\x0c\\r]+"
ORACLE_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, md5(coalesce(text, '')) AS document FROM documents
), w AS (
  SELECT r, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d
), win AS (
  SELECT r, i, array_to_string(words[i:i+4], ' ') AS g FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM w)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
), rep AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
), l AS (
  SELECT r, source, document, pos, raw, trim(regexp_replace(lower(raw), '{_WS}', ' ', 'g')) AS line
  FROM (SELECT r, source, document, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)
  WHERE regexp_matches(raw, '[^\\x20\\x09-\\x0D]')
), h AS (
  SELECT r, source, document, pos, raw, md5(line) AS line, len(string_split(line, ' ')) AS words FROM l
), common AS (
  SELECT source, line FROM h GROUP BY source, line HAVING count(DISTINCT document) >= {MAX_DOCUMENTS}
), gone AS (
  SELECT r, sum(words) AS removed_words FROM h JOIN common c ON h.source IS NOT DISTINCT FROM c.source AND h.line = c.line GROUP BY r
), dup AS (
  SELECT r, count(*) - count(DISTINCT raw) AS n_dup_lines FROM h GROUP BY r
), a AS (
  SELECT d.r, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r) LEFT JOIN gone USING (r)
), b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed, n_words - removed_words AS words_left FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND words_left >= {MIN_WORDS} AND 100 * words_left >= {MIN_SHARE} * n_words AS kept, removed_words
FROM b"""
