import datetime

import pytest
from pyspark.sql import functions as F

from agendario.functions import dates, similarity, text
from agendario.operators.matching import ratio

DAY = datetime.date


def values(spark, rows, column, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_norm_key(spark):
    rows = [("  Él & Ñandú's  CLUB!! ",), ("ﬁn øre",), (None,), ("",)]
    assert values(spark, rows, text.norm_key(F.col("x"))) == ["el and nandus club", "n re", None, ""]


def test_clean_and_words(spark):
    assert values(spark, [(" - A  b | ",)], text.clean(F.col("x"))) == ["A b"]
    assert values(spark, [("the big band",), ("bigband",)], text.contains_words(F.lit("big band"), F.col("x"))) == [True, False]
    assert values(spark, [("Ñu en Móstoles",), ("otro",)], text.search(F.col("x"), F.lit("mostoles ñu"))) == [True, False]
    assert values(spark, [("otro",)], text.search(F.col("x"), F.lit(""))) == [True]


def test_billing_and_country(spark):
    head, guests = text.billing(F.col("x"))
    assert values(spark, [("A + B+ C ",), ("Solo",)], F.struct(head, guests)) == [("A", ["B", "C"]), ("Solo", [])]
    name, code = text.country_suffix(F.col("x"))
    assert values(spark, [("Band (SE)",), ("Band (live)",)], F.struct(name, code)) == [("Band", "SE"), ("Band (live)", None)]


@pytest.mark.parametrize(("said", "least"), [("15€", 15.0), ("10-15 €", 10.0), ("Entrada libre", 0.0), ("10 + G.G", 10.0), ("12,5 €", 12.5), ("????", None)])
def test_price_min(spark, said, least):
    assert values(spark, [(said,)], text.price_min(F.col("x"))) == [least]


def test_url_functions(spark):
    url = "https://WWW.Shop.example.com/a?utm_source=x&id=3&fbclid=z#top"
    assert values(spark, [(url,), ("nothing",)], text.url_domain(F.col("x"))) == ["shop.example.com", ""]
    assert values(spark, [(url,), ("http://a/b?utm_x=1",), ("http://a/b",)], text.url_clean(F.col("x"))) == ["https://WWW.Shop.example.com/a?id=3", "http://a/b", "http://a/b"]
    assert values(spark, [("a.b.c",)], text.domain_suffixes(F.col("x"))) == [["a.b.c", "b.c", "c"]]


def test_dates(spark):
    today = F.lit("2026-12-20").cast("date")
    rows = [("2026-10-17",), ("17/1/27 x",), ("17 de octubre de 2026",), ("3 de enero",), ("20 de noviembre",), ("30/2/2026",), ("2026-02-30",), ("soon",)]
    assert values(spark, rows, dates.parse_date(F.col("x"), today)) == [DAY(2026, 10, 17), DAY(2027, 1, 17), DAY(2026, 10, 17), DAY(2027, 1, 3), DAY(2026, 11, 20), None, None, None]
    assert values(spark, [("21:05",), ("bad",)], dates.minutes(F.col("x"))) == [1265, None]


def test_recurrences_and_nearest_weekday(spark):
    start, end = F.lit("2026-03-02").cast("date"), F.lit("2026-03-31").cast("date")
    assert values(spark, [("",)], dates.recurrences(start, end, F.array(F.lit(5)), 3)) == [[DAY(2026, 3, 6), DAY(2026, 3, 13), DAY(2026, 3, 20)]]
    assert values(spark, [("",)], dates.nearest_weekday(start, F.lit(13), F.lit(5))) == [DAY(2026, 3, 13)]


def test_similarity_matches_the_python_form(spark):
    pairs = [("kings of noise", "king of noise"), ("abc", "abc"), ("abc", "xyz"), ("", "a"), ("los de siempre", "siempre los de"), ("a", "ba")]
    got = values(spark, pairs, similarity.indel_ratio(F.col("x"), F.col("y")), "x string, y string")
    assert got == pytest.approx([ratio(a, b) for a, b in pairs])
    assert values(spark, [("los de siempre", "siempre los de")], similarity.indel_ratio(similarity.token_sort(F.col("x")), similarity.token_sort(F.col("y"))), "x string, y string") == [100.0]
    assert values(spark, [("big band jazz", "big band")], similarity.token_set_ratio(F.col("x"), F.col("y")), "x string, y string") == [100.0]
