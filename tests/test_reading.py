import random

from pyspark.sql import functions as F

from agendario.operators import reading


def test_chosen_pages(spark):
    rows = [(1, "u1", "a", 0, False, True), (1, "u2", "b", 1, True, True), (1, "u3", "b", 2, False, True), (1, "u4", "c", 3, False, True), (1, "u5", "d", 4, False, True), (2, "v1", "a", 0, False, False), (2, "v2", "b", 1, False, False), (3, "w", "a", 0, False, True)]
    got = reading.chosen_pages(spark.createDataFrame(rows, "record int, url string, host string, position int, official boolean, gaps boolean"))
    assert sorted((r.record, r.n, r.url) for r in got.collect()) == [(1, 0, "u2"), (1, 1, "u1"), (1, 2, "u4"), (2, 0, "v1"), (3, 0, "w")]


def test_schedule_against_a_loop(spark):
    rng = random.Random(2)
    rows = [(f"u{rng.randint(0, 150)}", "", rng.random() < 0.4, rng.randint(1, 9), rng.randint(1, 5)) for _ in range(300)]
    rows = [(u, f"h{int(u[1:]) % 7}", g, d, int(u[1:]) % 5 + 1) for u, _, g, d, _ in rows]
    df = spark.createDataFrame(rows, "url string, host string, full boolean, day int, cost int")
    got = reading.schedule(df, F.col("cost"), ["full", "day"], ["full", "day"], 150.0, 40.0).collect()
    once, host, total, want = set(), {}, 0, {}
    for u, h, g, d, c in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if u in once:
            continue
        once.add(u)
        host[h] = host.get(h, 0) + c
        if host[h] <= 40:
            total += c
            if total <= 150:
                want[u] = float(host[h] - c)
    assert {r.url: r.starts for r in got} == want and 20 < len(want) < 120


def test_trusted_readings(spark):
    readings = spark.createDataFrame([(1, "hour", "20", "a", 0), (1, "hour", "21", "b", 1), (1, "price", "5", "a", 0), (1, "price", None, "b", 1), (2, "hour", "22", "c", 0), (2, "hour", "23", "d", 1)], "record int, field string, value string, host string, position int")
    trust = spark.createDataFrame([("a", "hour", 0.5), ("b", "hour", 0.9), ("c", "hour", 0.1)], "host string, field string, share double")
    assert sorted(tuple(r) for r in reading.trusted_readings(readings, trust, 0.3).collect()) == [(1, "hour", "21", "b"), (1, "price", "5", "a"), (2, "hour", "23", "d")]
