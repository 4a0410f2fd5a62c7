import datetime

from pyspark.sql import functions as F

from agendario.functions import names
from agendario.operators import agenda, lookup

DAY = datetime.date


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_festival_key_and_line_up(spark):
    assert values(spark, [("XII Festival de Jazz Móstoles 2026",), ("Móstoles Jazz Fest",)], names.festival_key(F.col("x"), F.array(F.lit("festival"), F.lit("fest"), F.lit("de")))) == ["jazz mostoles", "jazz mostoles"]
    said = names.line_up(F.col("x"), F.array(F.lit("y muchos mas"), F.lit("muchos mas")))
    assert values(spark, [("Sol Fest: A, B y C y muchos más",), ("Gira: A, B",)], F.struct(*said)) == [("Sol Fest", ["A", "B", "C"], True), (None, [], False)]


def test_honoured_and_country(spark):
    assert values(spark, [("Tributo a Queen",), ("Queen Tribute band",), ("Jam",)], names.honoured(F.col("x"))) == ["Queen", "Queen", None]
    assert values(spark, [("A (SE) + B (SE)",), ("A (SE) + B (NO)",), ("A (XX)",)], names.only_country(F.col("x"), ("SE", "NO"))) == ["SE", None, None]


def test_repair_encoding(spark):
    broken = "Canción de MÃ³stoles"
    rows = [(broken.replace("ó", "ó".encode().decode("cp1252")),), ("ya está bien",), (None,), ("",)]
    assert values(spark, rows, names.repair_encoding(F.col("x"))) == ["Canción de Móstoles", "ya está bien", None, ""]


def test_lookups(spark):
    entries = spark.createDataFrame([("a", "first", 1), ("a", "second", 2), ("b", "only", 3)], "name string, value string, pos int")
    assert rows_of(lookup.last_wins(entries, "name", "pos").select("name", "value")) == [("a", "second"), ("b", "only")]
    tree = spark.createDataFrame([(1, "rock", ["punk", "indie"]), (2, "pop", ["indie"])], "pos int, genre string, styles array<string>")
    assert rows_of(lookup.inverted(tree, "genre", "styles", "pos")) == [("indie", "rock"), ("punk", "rock")]
    rules = spark.createDataFrame([(1, "hard rock", "hard"), (2, "rock", "rock")], "pos int, keyword string, label string")
    texts = spark.createDataFrame([(1, "a hard rock night"), (2, "rocking"), (3, "old rock")], "id int, key string")
    assert rows_of(lookup.first_keyword(texts, "id", "key", rules)) == [(1, "hard"), (2, None), (3, "rock")]


def test_rules_and_those_that_match_nothing(spark):
    rows = spark.createDataFrame([(1, DAY(2026, 1, 1), "sol"), (2, DAY(2026, 1, 1), "luna"), (3, DAY(2026, 1, 2), "sol")], "id int, day date, venue string")
    rules = spark.createDataFrame([(DAY(2026, 1, 1), None, 2, "note", "n"), (DAY(2026, 1, 1), "sol", 1, "discard", "d"), (DAY(2026, 1, 9), None, 3, "note", "late")], "day date, venue string, pos int, action string, note string")
    got = agenda.apply_rules(rows, rules, "day", ["venue"])
    assert rows_of(got.select("id", "action")) == [(1, "discard"), (2, "note"), (3, None)]
    assert [r["note"] for r in agenda.unmatched_rules(rows, rules, "day", ["venue"]).collect()] == ["late"]
