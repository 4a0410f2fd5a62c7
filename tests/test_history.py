import datetime
import json
import random

from pyspark.sql import functions as F

from agendario.operators import history
from agendario.operators.history import Watched
from agendario.streaming import changes

DAY = datetime.date(2026, 1, 1)
W = Watched(always=("date_", "place"), compared=("hour", "price"), once=("event",), most=5)
SCHEMA = "key string, day date, date_ string, place string, hour string, price int, event string, state string, sources array<string>"


def snapshots(seed, n_keys=25, n_runs=30):
    rng = random.Random(seed)
    rows = []
    for k in range(n_keys):
        for d in range(n_runs):
            if rng.random() < 0.15:
                continue
            sources = rng.choice([["a"], ["a"], ["a"], ["b", "a"], ["a", "b", "a"]])
            rows.append((f"k{k}", DAY + datetime.timedelta(d), rng.choice(["d1", "d1", "d1", "d2"]), rng.choice(["p", "p", "q", None]), rng.choice(["20", "20", "21", None]), rng.choice([10, 10, 12]), rng.choice([None, None, "moved", "sold out"]), rng.choice(["ok", "ok", "ok", "possibly_cancelled"]), sources))
    return rows


def plain_history(rows):
    """By the description, record by record and run by run."""
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted((dict(zip(names, r)) for r in rows if r[0] == key), key=lambda r: r["day"])
        past = []
        for p, r in zip(own, own[1:]):
            found = [(f, p[f], r[f]) for f in W.always if p[f] != r[f]]
            if set(p["sources"]) == set(r["sources"]):
                found += [(f, str(p[f]), str(r[f])) for f in W.compared if p[f] is not None and r[f] is not None and p[f] != r[f]]
            found += [(f, None, r[f]) for f in W.once if r[f] is not None and r[f] != p[f]]
            found += [("gone", None, None)] if r["state"] == W.missing != p["state"] else [("back", None, None)] if p["state"] == W.missing != r["state"] else []
            for f, was, now in found:
                last = next((c for c in reversed(past) if c[1] == ("gone" if f == "back" else f)), None)
                near = last and (r["day"] - last[0]).days <= W.within
                if near and (f == "back" or (f in W.always + W.compared and last[2] == now)):
                    past.reverse()
                    past.remove(last)
                    past.reverse()
                elif not (f in W.once and any(c[1] == f and c[3] == now for c in past)):
                    past.append((r["day"], f, was, now))
            past = past[-W.most :]
        if past:
            out[key] = past
    return out


def test_batch_equals_plain_and_stream(spark, tmp_path):
    rows = snapshots(4)
    df = spark.createDataFrame(rows, SCHEMA)
    want = plain_history(rows)
    got = {r.key: [tuple(c) for c in r.changes] for r in history.history(df, W).collect()}
    assert got == want and len(want) > 15 and max(map(len, want.values())) == W.most

    for i in range(0, 30, 6):
        df.where((F.datediff("day", F.lit(DAY)) >= i) & (F.datediff("day", F.lit(DAY)) < i + 6)).coalesce(1).write.parquet(str(tmp_path / f"in/b={i:02}"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/b=*"))
        q = changes.change_history(stream, W, forget=60).writeStream.format("memory").queryName("histories").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination()
        last = {}
        for r in spark.table("histories").orderBy("day").collect():
            last[r.key] = [(datetime.date.fromisoformat(c["day"]), c["field"], c["was"], c["now"]) for c in json.loads(r.changes)]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    assert {k: v for k, v in last.items() if v} == want


def test_sources_and_retention(spark):
    d = [DAY + datetime.timedelta(i) for i in range(4)]
    rows = [("a", d[0], "d", "p", "20", 1, None, "ok", ["x"]), ("a", d[1], "d", "p", "21", 1, None, "ok", ["x", "y"]), ("a", d[2], "d", "p", "22", 1, None, "ok", ["y", "x"]), ("a", d[3], "d", "p", "21", 1, None, "ok", ["x", "y"])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(c) for r in history.history(df.where("day < '2026-01-04'"), W).collect() for c in r.changes] == [(d[2], "hour", "21", "22")]
    assert history.history(df, W).collect() == []
    assert history.retained(df, "day", F.lit("2026-02-02").cast("date")).count() == 3
