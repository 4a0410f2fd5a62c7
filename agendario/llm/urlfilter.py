"""URL filters: hashed host-suffix and path-prefix expressions joined with a rule table.

Each distinct URL is expanded into the expressions (host suffix, path prefix) whose shape some
rule has: host suffixes of as many labels as some rule's host has, and path prefixes of the lengths that occur
among the rules' paths (a rule's path is a prefix by characters). Expressions and rules meet in an equi-join
on the first four bytes of their SHA-256; the full digest then confirms a hit, and of all
confirmed rules the longest (host and path together, then host) decides.

The rule side is broadcast only if it has at most ``max_broadcast_rules`` rows; beyond that
the same join runs as a shuffle join, in which adaptive execution splits hot prefixes.

URLs that no rule fits get the method's own verdict: ``block`` if a label of the host has a word
of ``SUSPECT_WORDS`` between hyphens or as a whole, else ``allow``.

Defined cases: null URL, or one without ``://``: host and path are empty, no rule fits, allow.
Host is what the contract says, port and user included. Repeated rows are each returned; a
null ``page_id`` stays. An empty table gives no rows; other columns are ignored. Two rules of
the same expression: ``block`` wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import ascii_lower, table

#: Host labels' words that the method itself blocks; fixed values, a policy to be replaced by the user's.
SUSPECT_WORDS = ("spam", "pills", "casino", "porn", "xxx", "viagra", "betting", "warez", "malware", "phishing")

RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

HASH_BYTES = 4


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty without ``://``."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.regexp_replace(url, r"(?s)^.*?://", "")
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(known, ascii_lower(host)).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def _hashed(df: DataFrame) -> DataFrame:
    full = F.sha2(F.concat_ws("\n", "rule_host", "rule_path"), 256)
    return df.withColumn("digest", full).withColumn("prefix", F.substring("digest", 1, 2 * HASH_BYTES))


def judge(pages: DataFrame, rules: DataFrame, max_broadcast_rules: int = 100_000) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict; ``rules`` has host, path, verdict."""
    spark = pages.sparkSession
    known = _hashed(
        rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .groupBy("rule_host", "rule_path")
        .agg(F.max("rule_verdict").alias("rule_verdict"))
    )
    #: The lengths of rule paths: at most as many values as the longest path has characters.
    lengths = [r[0] for r in known.select(F.length("rule_path")).distinct().collect()] or [0]
    #: How many labels rule hosts have: at most as many values as the longest one has labels.
    counts = [r[0] for r in known.select(F.size(F.split("rule_host", r"\.", -1))).distinct().collect()] or [1]
    side = known.select("prefix", F.col("digest").alias("rule_digest"), "rule_host", "rule_path", "rule_verdict")
    if side.limit(max_broadcast_rules + 1).count() <= max_broadcast_rules:
        side = F.broadcast(side)

    urls = pages.select("url").distinct()
    host, path = parts(F.col("url"))
    size = F.length("host") - F.length(F.replace("host", F.lit("."))) + 1
    suffixes = F.filter(F.array(*[F.when(size >= n, F.substring_index("host", ".", -n)) for n in sorted(counts)]), lambda x: x.isNotNull())
    cuts = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]), lambda n: n <= F.length("path"))
    shapes = (
        urls.select("url", host.alias("host"), path.alias("path"))
        .where(F.col("host") != "")
        .select("url", "path", F.explode(suffixes).alias("rule_host"), cuts.alias("cuts"))
        .select("url", "rule_host", F.explode("cuts").alias("cut"), "path")
        .select("url", "rule_host", F.substring("path", F.lit(1), F.col("cut")).alias("rule_path"))
    )
    expressions = _hashed(shapes).select("url", "digest", "prefix")
    hits = expressions.join(side, "prefix").where(F.col("digest") == F.col("rule_digest"))
    rank = F.struct(F.length("rule_host") + F.length("rule_path"), F.length("rule_host"))
    best = hits.groupBy("url").agg(F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_verdict").alias("verdict")), rank).alias("best"))
    words = "|".join(SUSPECT_WORDS)
    own = F.when(F.col("host").rlike(rf"(^|[.-])({words})([.-]|$)"), "block").otherwise("allow")
    return (
        pages.select("page_id", "url")
        .join(best, "url", "left")
        .select("page_id", host.alias("host"), path.alias("path"), "best")
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", own).alias("verdict"))
    )


def rule_table(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), rule_table(spark))


_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
ORACLE_SQL = f"""
WITH u AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest, row_number() OVER () AS n FROM pages
), p AS (
  SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u
), r(rule_host, rule_path, rule_verdict) AS (VALUES {_VALUES}),
m AS (
  SELECT p.n, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY p.n ORDER BY length(rule_host) + length(rule_path) DESC, length(rule_host) DESC) AS k
  FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, m.rule AS rule,
  coalesce(m.rule_verdict, CASE WHEN regexp_matches(host, '(^|[.-])({"|".join(SUSPECT_WORDS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON m.n = p.n AND m.k = 1"""
