import datetime

from pyspark.sql import functions as F

from agendario.functions import dates

TODAY = datetime.date(2026, 9, 29)
CASES = [
    ("17 de octubre de 2026", (2026, 10, 17)), ("17 Oct 2026", (2026, 10, 17)), ("sábado 17 octubre", (2026, 10, 17)), ("Oct 17, 2026", (2026, 10, 17)), ("17.10.2026", (2026, 10, 17)), ("17-10-2026", (2026, 10, 17)), ("17/10/26", (2026, 10, 17)), ("2026-10-7", (2026, 10, 7)),
    ("Sáb. 3 de enero", (2027, 1, 3)), ("20 de agosto", (2026, 8, 20)), ("1 de agosto", (2027, 8, 1)), ("5 septiembre 2027", (2027, 9, 5)), ("12 setiembre", (2026, 9, 12)), ("3 sept", (2026, 9, 3)), ("21 horas, 4 de noviembre", (2026, 11, 4)), ("March 3", (2027, 3, 3)), ("31/02/2026", None),
    ("30 de febrero", None), ("2026-13-01", None), ("none", None), ("", None), (None, None), ("a las 21", None), ("10 dec 2026 o 11 dec 2026", (2026, 12, 10)), ("May 5", (2027, 5, 5)), ("abril 9 2027", (2027, 4, 9)),
]


def test_every_notation(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.d for r in rows.select("i", dates.parse_date(F.col("t"), F.lit(TODAY)).alias("d")).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(CASES)] == [(t, d and datetime.date(*d)) for t, d in CASES]
    given = rows.where("i IN (2, 8)").select("i", dates.parse_date(F.col("t"), F.lit(TODAY), F.lit(2025)).alias("d")).orderBy("i").collect()
    assert [r.d for r in given] == [datetime.date(2025, 10, 17), datetime.date(2025, 1, 3)]
