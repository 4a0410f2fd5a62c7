import datetime

from pyspark.sql import functions as F

from agendario.operators import cluster, metrics, resolve, sinks, snapshot, temporal
from agendario.sources import readers

DAY = datetime.date


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_resolve_by_priority(spark):
    rows = spark.createDataFrame([("a", "20:00", 1), ("a", "21:00", 2), ("b", "20:00", 1), ("b", "21:00", 1), ("c", "20:00", 3), ("c", None, 1), ("c", "20:00", 1)], "k string, v string, p int")
    got = resolve.resolve_by_priority(rows, ["k"], "v", "p")
    assert rows_of(got.select("k", "n_versions", "value", "state")) == [("a", 2, "20:00", "resolved"), ("b", 2, None, "conflict"), ("c", 1, "20:00", "single")]


def test_first_by_priority_skips_nulls(spark):
    rows = spark.createDataFrame([("a", None, 1, 0), ("a", "x", 2, 1), ("a", "y", 2, 0)], "k string, v string, p int, pos int")
    assert rows_of(resolve.first_by_priority(rows, ["k"], ["v"], "p", "pos")) == [("a", "y")]


def test_consensus_drops_wide_ties(spark):
    votes = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 1.0), ("a", "z", 1.0), ("b", "x", 5.0), ("b", "y", 4.0), ("b", "z", 0.5)], "k string, o string, w double")
    assert rows_of(resolve.consensus(votes, ["k"], "o", "w")) == [("b", "x", 5.0), ("b", "y", 4.0)]


def test_snapshot_changes_and_reconcile(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y")], "id int, v string, s string")
    new = spark.createDataFrame([(1, "c", "x"), (3, None, "y"), (4, "d", "y")], "id int, v string, s string")
    assert rows_of(snapshot.changes(old, new, "id", ["v"])) == [(1, "v", "a", "c"), (2, "gone", None, None), (4, "new", None, None)]
    whole = spark.createDataFrame([("x", True)], "s string, complete boolean")
    assert rows_of(snapshot.reconcile(new.where("id <> 3"), old, "id", "s", whole)) == [(1, "kept"), (2, "possibly_cancelled"), (3, "carried"), (4, "new")]
    cached = snapshot.complete_with_cache(new, old, ["id"])
    assert rows_of(cached.select("id", "from_cache")) == [(1, False), (2, True), (3, False), (4, False)]


def test_temporal_joins(spark):
    l = spark.createDataFrame([(1, "k", DAY(2026, 1, 10)), (2, "k", DAY(2026, 3, 1)), (3, "z", DAY(2026, 1, 1))], "id int, k string, day date")  # noqa: E741
    r = spark.createDataFrame([(7, "k", DAY(2026, 1, 8)), (8, "k", DAY(2026, 1, 12)), (9, "k", DAY(2026, 2, 20))], "id int, k string, day date")
    pairs = temporal.within_days(l, r, ["k"], "day", 9)
    assert rows_of(pairs.select("id", "r_id")) == [(1, 7), (1, 8), (2, 9)]
    assert rows_of(temporal.unique_pairs(pairs, "id", "r_id").select("id", "r_id")) == [(2, 9)]
    assert rows_of(temporal.nearest(l, r.select("k", "day"), ["k"], "day").select("id", "nearest")) == [(1, DAY(2026, 1, 8)), (2, DAY(2026, 2, 20)), (3, None)]


def test_usual_value_levels(spark):
    rows = spark.createDataFrame([("p", 4, "21:00")] * 4 + [("p", 5, "20:00")] + [("q", 1, "19:00")] * 2, "place string, weekday int, hour string")
    got = metrics.usual_value(rows, "place", "weekday", "hour")
    assert rows_of(got.select("place", "weekday", "usual")) == [("p", 4, "21:00"), ("p", None, "21:00")]


def test_clusters_first_fit(spark):
    day = DAY(2026, 5, 1)
    rows = spark.createDataFrame([(day, 1, ["kings of noise"], "sala sol", 2, None), (day, 2, ["king of noise"], "", 3, None), (day, 3, ["kings of noise"], "other hall", 2, None), (day, 4, ["nobody"], "sala sol", 1, None)], "day date, row_id long, names array<string>, venue string, priority int, minutes int")
    assert rows_of(cluster.clusters(rows, ["day"])) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_json_ld_scan(spark):
    page = '<script type="application/ld+json">[{"@type":"MusicEvent","name":"A","startDate":"2026-05-01T21:30:00","location":{"name":"Sol"},"offers":{"price":"12"}},{"@type":"Place","name":"x"}]</script><script type="application/ld+json">{"@type":"Event","name":"B","startDate":"2026-06-02T00:00"}</script>'
    pages = spark.createDataFrame([(1, page), (2, "<p>none</p>"), (3, None)], "page_id int, html string")
    assert rows_of(readers.json_ld(pages, "page_id", "html")) == [(1, "A", DAY(2026, 5, 1), "21:30", "Sol", "12"), (1, "B", DAY(2026, 6, 2), None, None, None)]


def test_crawl_rules(spark):
    said = "User-agent: one\nUser-agent: two\nDisallow: /a # no\nAllow: /a/*.html$\n\nUser-agent: *\nDisallow: /"
    rules = readers.crawl_rules(spark.createDataFrame([("h", said)], "host string, txt string"), "host", "txt")
    assert rows_of(rules.select("agent", "allow", "path")) == [("*", False, "/"), ("one", False, "/a"), ("one", True, "/a/*.html$"), ("two", False, "/a"), ("two", True, "/a/*.html$")]
    urls = spark.createDataFrame([("h", p) for p in ("/a/b.html", "/a/b.pdf", "/c")], "host string, p string")
    got = readers.may_fetch(urls, rules.where("agent = 'one'"), "host", "p")
    assert rows_of(got.select("p", "allow")) == [("/a/b.html", True), ("/a/b.pdf", False), ("/c", True)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, DAY(2026, 5, 1), "A; b, " + "ñ" * 60, ["x", "y"], None)], "id int, day date, title string, tags array<string>, note string")
    assert rows_of(sinks.light(rows, "id", ["title", "note"]))[0][1].startswith('{"title":"A; b, ')
    event = sinks.calendar_events(rows, F.col("id").cast("string"), F.col("day"), F.col("title"), F.lit("here"), datetime.datetime(2026, 1, 1)).first()["vevent"]
    assert "DTSTART;VALUE=DATE:20260501" in event and "A\\; b\\, " in event.replace("\r\n ", "")
    assert all(len(x.encode()) <= 75 for x in event.split("\r\n"))
    sinks.write_csv(rows, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), sep=";", header=True).first()["tags"] == "x, y"
    sinks.write_by_day(rows, "day", str(tmp_path / "days"))
    assert (tmp_path / "days" / "day=2026-05-01").is_dir()
