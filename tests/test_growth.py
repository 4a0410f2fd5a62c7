"""Work that must not grow faster than the input: what steps hand on, counted."""

import datetime

from pyspark.sql import functions as F

from agendario.functions import fields
from agendario.operators import cluster, consolidate, matching
from agendario.operators.matching import Rules

DAY = datetime.date(2026, 5, 1)


def spied(monkeypatch, module, name, count):
    """The counts of the first argument of each call."""
    seen, real = [], getattr(module, name)

    def call(df, *rest):
        seen.append(count(df))
        return real(df, *rest)

    monkeypatch.setattr(module, name, call)
    return seen


def test_edges_are_of_names_and_not_of_announcements(spark, monkeypatch):
    seen = spied(monkeypatch, cluster, "groups", lambda df: df.count())
    names = [f"grupo de ejemplo {c}" for c in "abcdefgh"]
    rows = [(k, DAY, [names[k % 8]], f"lugar {'abcdefghijklmnopqrst'[k % 19] * 6}" if k % 5 else "", 1, 1200 + k) for k in range(400)]
    got = cluster.clusters(spark.createDataFrame(rows, "row_id long, day date, names array<string>, venue string, priority int, minutes int"), ["day"], Rules()).collect()
    assert len(got) == 400 and len({r.cluster_id for r in got}) < 60
    assert max(seen) <= 200, seen


def test_acts_are_told_by_words_and_not_by_names(spark):
    rows = [(1, f"orquesta azul {k}", f"v{v}", v) for k in range(30) for v in range(2)]
    announced = spark.createDataFrame(rows, "b long, h string, v string, place long").withColumn("ws", matching.act_words(F.col("h")))
    assert sorted(map(tuple, matching.acts_told(announced, Rules()).collect())) == [(1, f"v{v}", "orquesta azul", "orquesta azul") for v in range(2)]


def test_cities_are_looked_up_once(spark, monkeypatch):
    seen = spied(monkeypatch, consolidate, "towns_of", lambda df: df.count())
    rows = [(k, DAY, f"Name {k}", [], "Venue", ["Madrid", "Getafe", "", None, "Toledo"][k % 5], 1200, None, "u", "web") for k in range(500)]
    listings = spark.createDataFrame(rows, "row_id long, day date, name string, guests array<string>, venue string, city string, minutes int, price string, url string, source string")
    sources = spark.createDataFrame([("web", 1, "g", "Madrid")], "source string, priority int, grp string, town string")
    towns, venues = spark.createDataFrame([("madrid", "Madrid"), ("getafe", "Getafe")], "alias string, town string"), spark.createDataFrame([], "venue_key string, town string")
    kept, rejected = consolidate.prepare(listings, sources, towns, venues, F.lit(DAY), F.lit(DAY), ("tba",))
    assert kept.count() == 400 and [tuple(r) for r in rejected.collect()] == [("web", "town", 100)]
    assert max(seen) <= 3, seen


def test_a_text_is_read_once_for_all_styles(spark):
    df = spark.createDataFrame([(1, "Rock alternativo y rock"), (2, None), (3, "pop, rock"), (4, "")], "k int, t string")
    out = df.select("k", fields.styles_in_text(F.col("t"), ("rock", "pop", "rock alternativo")).alias("s"))
    assert {r.k: r.s for r in out.collect()} == {1: ["rock alternativo"], 2: [], 3: ["rock", "pop"], 4: []}
    assert out._jdf.queryExecution().analyzed().toString().count("regexp_replace(") == 1


def test_a_line_up_is_folded_over_what_is_said_and_not_how_often(spark, monkeypatch):
    from agendario.operators import lineups

    sizes = []
    rows = [(1, k, k % 3, ["Sur Fest (Uno Dos, Tres Cuatro)"] if k % 2 else ["Sur Fest", "Cinco Seis"], None) for k in range(500)]
    monkeypatch.setattr(lineups, "written", lambda df, name: (sizes.append(df.count()), df)[1])
    got = lineups.line_ups(spark.createDataFrame(rows, "cluster_id long, row_id long, priority int, names array<string>, festival boolean")).collect()
    assert [(r.festival, r.artists) for r in got] == [("Sur Fest", ["Cinco Seis", "Uno Dos", "Tres Cuatro"])] and sizes == [2]


def test_crawl_files_and_keyword_rules_are_decided_in_their_rows(spark):
    from agendario.operators import lookup
    from agendario.sources import readers

    said = "User-agent: *\nCrawl-delay: 5\nUser-agent: own\nCrawl-delay: 0\nUser-agent: own\nCrawl-delay: x\nCrawl-delay: 3"
    delay = readers.crawl_delay(spark.createDataFrame([(1, said), (2, "User-agent: *\nCrawl-delay: 4"), (3, None)], "k int, t string"), "k", "t", "own", fallback=True)
    assert {r.k: r.delay for r in delay.collect()} == {1: 3.0, 2: 4.0, 3: None}
    rules = spark.createDataFrame([(2, "rock", "b"), (1, "hard rock", "a")], "pos int, keyword string, label string")
    label = lookup.first_keyword(spark.createDataFrame([(1, "a hard rock"), (2, "rock"), (3, None), (4, "rocks")], "k int, t string"), "k", "t", rules)
    assert {r.k: r.label for r in label.collect()} == {1: "a", 2: "b", 3: None, 4: None}
    assert not any("hashpartitioning" in df._jdf.queryExecution().executedPlan().toString() for df in (delay, label))


def test_phrases_and_claims_need_no_index(spark, monkeypatch):
    from agendario.operators import dictionary, positions

    for module in (dictionary, positions):
        monkeypatch.setattr(module, "index", None, raising=False)
    docs = spark.createDataFrame([(1, "a b c d"), (2, "c d a")], "k int, t string")
    phrases = spark.createDataFrame([("a b",), ("c d",)], "p string")
    assert sorted(map(tuple, dictionary.phrases_in(docs, "k", "t", phrases, "p", most=1).collect())) == [(1, "a b", 0), (1, "c d", 4), (2, "c d", 0)]
    claims = spark.createDataFrame([(1, "a b", "c d")], "claim int, name string, phrase string")
    assert [tuple(r) for r in positions.near_names(docs, "k", "t", claims).collect()] == [(1, 1, 1)]


def test_nested_values_are_written_whole(spark, tmp_path):
    from agendario.sources import jsonwalk, tables

    rows = spark.range(50).select("id", F.try_parse_json(F.lit('{"a":[{"b":{"@type":"Event","name":"x"}}],"n":1}')).alias("v"))
    found = jsonwalk.walk(rows, ["id"], "v", jsonwalk.typed("Event"))
    assert found.count() == 50 and {r.path for r in found.collect()} == {"$.a[0].b"}
    out = tables.written(rows, "whole")
    import pyarrow.parquet as pq

    folder = out.inputFiles()[0].removeprefix("file://")
    assert {f.name for f in pq.read_schema(folder).field("v").type} == {"value", "metadata"}
    assert spark.conf.get("spark.sql.variant.inferShreddingSchema") == "true"


def test_votes_that_count_alike_are_one(spark):
    from agendario.operators import evidence

    rows = [(k % 3, k % 5, "abc"[k % 7 % 3], k % 4 == 0 or None, k % 5 == 4, 1.0 + k % 2) for k in range(2000)]
    votes = spark.createDataFrame(rows, "k int, source int, `group` string, weak boolean, doubtful boolean, weight double")
    one = evidence.tallied(votes, ["k"])
    assert one.count() <= 3 * 5 * 3 * 2 * 2

    def found(v):
        return sorted((r.k, r.group, round(r.weight, 6)) for r in evidence.groups_by_evidence(evidence.doubted(v, ["k"]), ["k"]).collect())

    assert found(one) == found(votes) and found(one)


def test_only_keys_of_both_sides_are_taken_apart(spark, monkeypatch):
    from agendario.operators import deep

    sizes, real = [], deep.written
    monkeypatch.setattr(deep, "written", lambda df, name: (out := real(df, name), name == "leaves" and sizes.append(out.count()))[0])
    v = F.try_parse_json(F.concat(F.lit('{"a":{"n":'), F.col("id").cast("string"), F.lit("}}"))).alias("v")
    ours, theirs = spark.range(40).select("id", v), spark.range(38, 80).select("id", F.when(F.col("id") != 79, F.try_parse_json(F.lit('{"a":{"m":1}}'))).alias("v"))
    got = {r.id: r.v for r in deep.deep_merge(ours, theirs, "id", "v").select("id", F.to_json("v").alias("v")).collect()}
    assert len(got) == 79 and got[3] == '{"a":{"n":3}}' and got[38] == '{"a":{"m":1,"n":38}}' and got[78] == '{"a":{"m":1}}'
    assert sizes and max(sizes) == 4, sizes
