import datetime
import random

from pyspark.sql import functions as F

from agendario.functions.similarity import lcs
from agendario.operators import consolidate, evidence
from agendario.operators.matching import Rules, like, like_flexible, ratio

DAY = datetime.date
RULES = Rules(generic=frozenset(["banda"]), kinds=frozenset(["sala", "club"]), common=frozenset(["festival", "the"]), never_same=frozenset([frozenset(["sala sol", "sala sola"])]))


def plain_lcs(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(before[j] + 1 if x == y else max(before[j + 1], now[-1]))
        before = now
    return before[-1]


def test_bit_parallel_lcs_equals_the_table():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ("".join(rng.choice("abcd ") for _ in range(rng.randint(0, 90))) for _ in range(2))
        assert lcs(a, b) == plain_lcs(a, b)
    assert ratio("", "") == 100.0


def test_names():
    assert like("kings of noise", "king of noise", RULES) and not like("banda", "bandas", RULES) and like("banda", "banda", RULES) and not like("", "", RULES)
    assert like_flexible("los de siempre", "gira los de siempre 2026", RULES) and like_flexible("acdc", "alpha charlie delta charlie", RULES) and not like_flexible("rem", "blur", RULES)


SCHEMA = "row_id long, day date, name string, guests array<string>, venue string, city string, minutes int, price string, url string, source string"
SOURCES = [("web", 1, "web", "Madrid"), ("shop", 2, "shop", None), ("agenda", 3, "ag", "Madrid"), ("agenda2", 3, "ag", "Madrid"), ("blog", 4, "blog", "Madrid")]
TOWNS = [("madrid", "Madrid"), ("getafe", "Getafe")]


def prepared(spark, rows):
    sources = spark.createDataFrame(SOURCES, "source string, priority int, grp string, town string")
    first, last = F.lit("2026-05-01").cast("date"), F.lit("2026-06-01").cast("date")
    return consolidate.prepare(spark.createDataFrame(rows, SCHEMA), sources, spark.createDataFrame(TOWNS, "alias string, town string"), spark.createDataFrame([("sala sol", "Madrid")], "venue_key string, town string"), first, last, ("tba", "y mas"))


def test_scope_and_cleaning(spark):
    d = DAY(2026, 5, 2)
    rows = [
        (1, d, "Kings", [], "Sala Sol", "Madrid", 1200, None, "u", "web"), (2, d, "TBA", [], "Sala Sol", "", None, None, "u", "web"), (3, DAY(2026, 7, 1), "Late", [], "", "", None, None, "u", "web"),
        (4, d, "Far away", [], "", "Toledo", None, None, "u", "agenda"), (5, d, "No town", [], "Other", "", None, None, "u", "shop"), (6, d, "MuÃ±oz", [], "SALA SOL", "", None, None, "u", "web"),
        (7, d, "South", [], "", "Getafe (Madrid)", None, None, "u", "shop"), (8, d, "Sun", [], "Sala Sol", "", None, None, "u", "shop"), (9, d, None, [], None, None, None, None, None, "blog"),
    ]
    kept, rejected = prepared(spark, rows)
    assert sorted((r["row_id"], r["town"], r["venue"]) for r in kept.collect()) == [(1, "Madrid", "Sala Sol"), (7, "Getafe", ""), (8, "Madrid", "Sala Sol")]
    assert sorted(tuple(r) for r in rejected.collect()) == sorted([("web", "no name", 1), ("web", "day", 1), ("agenda", "town", 1), ("shop", "town", 1), ("web", "encoding", 1), ("blog", "no name", 1)])


def test_records_and_venue_conflicts(spark):
    d = DAY(2026, 5, 2)
    rows = [
        (1, d, "Kings of Noise", ["Guest One"], "Sala Sol", "", 1200, "10 €", "a", "web"), (2, d, "KING OF NOISE", ["Guest two"], "Sol", "", 1230, "12 €", "b", "agenda"), (3, d, "Kings of noise", [], "", "", None, None, "c", "blog"),
        (4, d, "Moon", [], "Luna", "", 1200, None, "d", "agenda"), (5, d, "Moon", [], "Teatro Real", "", 1200, None, "e", "agenda2"),
        (6, d, "Sun", [], "Luna", "", 1200, None, "f", "web"), (7, d, "Sun", [], "Mar", "", 1200, None, "g", "blog"),
        (8, d, "Twice", [], "Luna", "", 1080, None, "h", "web"), (9, d, "Twice", [], "Rio", "", 1320, None, "i", "web"),
    ]
    events = consolidate.merge_venues(consolidate.records(prepared(spark, rows)[0], RULES))
    got = {r["event_id"]: r for r in events.collect()}
    kings = got[1]
    assert (kings["artist"], kings["guests"], kings["venue"], kings["minutes"], kings["price"], kings["state"], len(kings["sources"])) == ("Kings of Noise", ["Guest One", "Guest two", "KING OF NOISE"], "Sala Sol", 1200, "10 €", "contrasted", 3)
    assert (got[4]["venue"], got[4]["conflicts"], got[4]["state"]) == (None, ["venue"], "conflict") and 5 not in got
    assert (got[6]["venue"], got[6]["conflicts"]) == ("Luna", []) and 7 not in got
    assert {8, 9} <= set(got) and set(got) == {1, 4, 6, 8, 9}


def test_reconcile_in_passes(spark):
    schema = "event_id long, day date, artist string, venue string, sources array<struct<source:string>>"
    d = DAY(2026, 5, 2)
    now = [(1, d, "Same", "Sol", [("web",)]), (2, d, "Long name here in town", "Luna", [("web",)]), (3, DAY(2026, 5, 20), "Moved", "Sol", [("web",)]), (4, d, "Fresh", "Mar", [("web",)])]
    was = [(11, d, "Same", "Sol", [("web",)]), (12, d, "Long name here", "Luna", [("web",)]), (13, DAY(2026, 5, 5), "Moved", "Sol", [("web",)]), (14, d, "Gone", "Rio", [("web",)]), (15, d, "Part", "Rio", [("web",), ("blog",)]), (16, DAY(2026, 4, 1), "Old", "Rio", [("web",)])]
    complete = spark.createDataFrame([("web", True), ("blog", False)], "source string, complete boolean")
    got = consolidate.reconcile(spark.createDataFrame(now, schema), spark.createDataFrame(was, schema), complete, F.lit("2026-05-01").cast("date"), RULES)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted([(1, 11, "kept"), (2, 12, "renamed"), (3, 13, "moved"), (4, None, "new"), (None, 14, "possibly_cancelled"), (None, 15, "carried"), (None, 16, "past")], key=repr)


def test_alias_pairs_against_all_pairs(spark):
    rng = random.Random(5)
    words = ["luna", "lunas", "sol", "teatro", "real", "reales", "norte", "plaza"]
    names = sorted({" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(60)})
    got = {(r[0], r[1]) for r in evidence.alias_pairs(spark.createDataFrame([(n,) for n in names], "key string"), "key", 90.0).collect()}
    alike = {(a, b) for a in names for b in names if a < b and ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) >= 90}
    assert got == alike and alike
