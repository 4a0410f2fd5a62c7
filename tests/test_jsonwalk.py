import datetime
import json
import random

from pyspark.sql import functions as F

from agendario.sources import jsonwalk, readers

DAY = datetime.date


def tree(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.15:
        return rng.choice([1, -2.5, True, None, "x", "MusicEvent", "{not json", '{"title":1,"start":null}', '[{"title":"in text","start":"2026-05-01","more":[]}]', '[1,"[{\\"title\\":3,\\"start\\":4}]"]'])
    if kind < 0.4:
        return [tree(rng, depth - 1) for _ in range(rng.randint(0, 4))]
    out = {rng.choice("abcde") + rng.choice(["", ".x", " y", "'z"]): tree(rng, depth - 1) for _ in range(rng.randint(0, 4))}
    if rng.random() < 0.4:
        out["@type"] = rng.choice(["Event", "MusicEvent", "Eventful", ["Thing", "DanceEvent"], [3, None], {"a": "Event"}, None, ["Place"]])
    if rng.random() < 0.3:
        out |= {"title": rng.choice([None, "t", 5]), "start": rng.choice(["2026-05-01", None])}
    return out


def plain_walk(x, hit, in_texts):
    if isinstance(x, dict):
        if hit(x):
            return [x]
        return [h for v in x.values() for h in plain_walk(v, hit, in_texts)]
    if isinstance(x, list):
        return [h for v in x for h in plain_walk(v, hit, in_texts)]
    if in_texts and isinstance(x, str) and x[:1] in ("{", "["):
        try:
            return plain_walk(json.loads(x), hit, in_texts)
        except ValueError:
            pass
    return []


def is_event(x):
    t = x.get("@type")
    return any(isinstance(y, str) and y.endswith("Event") for y in (t if isinstance(t, list) else [t]))


def shown(x):
    return json.dumps(x, sort_keys=True)


def test_walk_equals_plain_recursion(spark):
    rng = random.Random(9)
    trees = [tree(rng, rng.randint(0, 9)) for _ in range(300)]
    deep = {"@type": "Event", "name": "deep"}
    for i in range(40):
        deep = [deep] if i % 3 else {"k": deep, "n": i}
    trees += [deep, [], {}, None, {"@type": "Event", "sub": {"@type": "Event"}}]
    rows = spark.createDataFrame([(i % 290, json.dumps(t)) for i, t in enumerate(trees)], "k int, raw string").select("k", F.try_parse_json("raw").alias("v"))
    for hit, plain, in_texts in ((jsonwalk.typed("Event"), is_event, False), (jsonwalk.having("title", "start"), lambda x: "title" in x and "start" in x, True)):
        got = jsonwalk.walk(rows, ["k"], "v", hit, in_texts).select("k", "path", F.to_json("v").alias("v")).collect()
        want = sorted((i % 290, shown(h)) for i, t in enumerate(trees) for h in plain_walk(t, plain, in_texts))
        assert sorted((r.k, shown(json.loads(r.v))) for r in got) == want and len(want) > 40


def test_event_fields(spark):
    said = [
        {"@type": ["Thing", "MusicEvent"], "name": " A ", "startDate": "2026-5-1T9:30", "location": [{"name": "Sol", "address": [{"addressLocality": "Madrid"}]}], "offers": [{"price": 12.5, "priceCurrency": "EUR"}, {"price": 1}], "image": [{"url": "http://i/1"}], "url": "u1"},
        {"@type": "Event", "name": "Many", "startDate": "2026-05-02T00:00", "performer": [{"name": "One"}, {"name": " "}, "x", {"name": "Two"}], "location": {"name": "", "address": "Calle 1, Getafe"}, "offers": {"price": "0"}, "image": "no", "@id": "id2"},
        {"@type": "Event", "name": "Bad day", "startDate": "2026-13-40"}, {"@type": "Event", "name": "None"}, {"@type": "Event", "name": "Bare", "startDate": "2026-06-01", "offers": [], "location": [], "image": {"contentUrl": "https://i/3"}, "performer": {"name": "Solo"}},
    ]
    rows = spark.createDataFrame([(1, json.dumps({"x": {"y": said}}))], "k int, raw string").select("k", F.try_parse_json("raw").alias("v"))
    got = jsonwalk.event_fields(jsonwalk.walk(rows, ["k"], "v", jsonwalk.typed("Event")), ["k"], F.lit("page")).drop("path").orderBy("day").collect()
    assert [tuple(r) for r in got] == [
        (1, "A", [], DAY(2026, 5, 1), "09:30", "Sol", "Madrid", "12.5 EUR", "u1", "http://i/1"),
        (1, "One", ["Two"], DAY(2026, 5, 2), None, None, "Calle 1, Getafe", None, "id2", None),
        (1, "Bare", [], DAY(2026, 6, 1), None, None, None, None, "page", "https://i/3"),
    ]


def test_control_characters_and_pages(spark):
    page = '<script type="application/ld+json">{"@graph":[{"a":{"b":[{"@type":"TheaterEvent","name":"Line\nbreak","startDate":"2026-05-03"}]}}]}</script><script type="application/ld+json">broken {</script>'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    assert [tuple(r) for r in readers.json_ld(pages, "page_id", "html").collect()] == [(1, "Line break", DAY(2026, 5, 3), None, None, None)]


def test_calendar_in_settings(spark):
    raw = json.dumps({"view": {"options": json.dumps({"events": [{"title": "A", "start": "2026-05-01T20:00", "url": "a"}, {"title": None, "start": "x"}]})}})
    got = readers.calendar_json(spark.createDataFrame([(1, raw), (2, "[]"), (3, None)], "k int, raw string"), "k", "raw").collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(1, 0, "A", DAY(2026, 5, 1), "20:00", "a"), (1, 1, None, None, None, None)], key=repr)


def test_each_page_by_its_first_scan(spark):
    ld = '<script type="application/ld+json">{"x":[{"@type":["Event"],"name":"L","startDate":"2026-05-01T20:00"}]}</script>'
    empty = '<script type="application/ld+json">{"@type":"Place"}</script>'
    micro = '<p itemtype="https://schema.org/Event"><b itemprop="name">M</b><i itemprop="startDate" content="2026-05-02T21:00"></i></p>'
    lines = "<p>2026-05-03</p><p>N</p>"
    pages = spark.createDataFrame([(1, ld + micro + lines), (2, empty + micro + lines), (3, empty + lines), (4, "<p>none</p>"), (5, None), (1, ld)], "k int, html string")
    got = sorted((tuple(r) for r in readers.first_that_reads(pages, "k", "html").collect()), key=repr)
    assert got == sorted([(1, "json_ld", "L", DAY(2026, 5, 1), "20:00")] * 2 + [(2, "microdata", "M", DAY(2026, 5, 2), "21:00"), (3, "lines", "N", DAY(2026, 5, 3), None)], key=repr)
