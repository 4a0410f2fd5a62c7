import json
import random

from pyspark.sql import functions as F

from agendario.operators import deep


def value(rng, depth):
    if depth == 0 or rng.random() < 0.25:
        return rng.choice([1, "x", None, True, [1, {"a": 2}], {}, [], 2.5])
    return {rng.choice("abcd"): value(rng, depth - 1) for _ in range(rng.randint(0, 3))}


def plain_merge(a, b, wins, rules, path=()):
    """Both values by recursion: ``wins`` is the side preferred by default, the longest prefix of a path decides."""
    if isinstance(a, dict) and a and isinstance(b, dict) and b:
        return {k: plain_merge(a[k], b[k], wins, rules, (*path, k)) if k in a and k in b else a.get(k, b.get(k)) for k in {*a, *b}}
    for prefix, who in sorted(rules.items(), key=lambda r: -len(r[0].split("."))):
        names = tuple(prefix.split("."))
        if path[: len(names)] == names:
            wins = who
            break
    return a if wins == "ours" else b


def test_leaves_and_back(spark):
    rng = random.Random(1)
    values = [value(rng, rng.randint(0, 7)) for _ in range(80)]
    deepest = {"n": 1}
    for _ in range(15):
        deepest = {"k": deepest, "l": [1]}
    values.append(deepest)
    rows = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, raw string").select("i", F.try_parse_json("raw").alias("v"))
    back = deep.together(deep.leaves(rows, "i", "v"), "i").select("i", F.to_json("v").alias("v")).collect()
    assert {r.i: json.loads(r.v) for r in back} == dict(enumerate(values))


def test_merge_against_recursion(spark):
    rng = random.Random(5)
    rules = {"a": "theirs", "a.b": "ours"}
    pairs = [tuple({k: value(rng, 3) for k in rng.sample("abcd", rng.randint(1, 4))} for _ in range(2)) for _ in range(90)] + [({}, {"a": 1}), (3, {"a": 1}), (None, None)]
    schema = "i int, raw string, day string"
    ours = spark.createDataFrame([(i, json.dumps(a), "2026-01-02" if i % 2 else "2026-01-04") for i, (a, _) in enumerate(pairs)] + [(900, '{"only":1}', "x")], schema)
    theirs = spark.createDataFrame([(i, json.dumps(b), "2026-01-03") for i, (_, b) in enumerate(pairs)] + [(901, '{"only":2}', "x")], schema)
    a, b = (df.select("i", F.try_parse_json("raw").alias("v"), "day") for df in (ours, theirs))
    got = {r.i: json.loads(r.v) for r in deep.deep_merge(a, b, "i", "v", "day", rules).select("i", F.to_json("v").alias("v")).collect()}
    for i, (x, y) in enumerate(pairs):
        assert got[i] == plain_merge(x, y, "theirs" if i % 2 else "ours", rules), (x, y)
    assert got[900] == {"only": 1} and got[901] == {"only": 2}


def test_upsert_and_its_report(spark):
    stored = spark.createDataFrame([(1, "a", 10, "d0"), (2, "b", None, "d0"), (3, "c", 30, "d0")], "k int, name string, n int, stamp string")
    batch = spark.createDataFrame([(1, "A", None), (2, "b", None), (4, "new", 4), (5, None, None), (6, "no", 6), (4, "zz", 5)], "k int, name string, n int")
    asked = spark.createDataFrame([(1,), (2,), (4,), (5,), (7,)], "k int")
    table, report = deep.upsert(stored, batch, asked, "k", ["name", "n"], F.lit("d1"))
    after = sorted(map(tuple, table.collect()))
    assert after == [(1, "A", 10, "d1"), (2, "b", None, "d0"), (3, "c", 30, "d0"), (4, "new", 4, "d1")]
    assert {r.k: (r.outcome, r.changed) for r in report.collect()} == {1: ("updated", ["name"]), 2: ("same", []), 4: ("inserted", ["name", "n"]), 5: ("empty", []), 6: ("unasked", []), 7: ("unanswered", [])}
    again, report = deep.upsert(table, batch, asked, "k", ["name", "n"], F.lit("d2"))
    assert sorted(map(tuple, again.collect())) == after and {r.k: r.outcome for r in report.collect()} == {1: "same", 2: "same", 4: "same", 5: "empty", 6: "unasked", 7: "unanswered"}
