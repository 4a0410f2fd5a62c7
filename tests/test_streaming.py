import datetime

from pyspark.sql import functions as F

from agendario.streaming import incremental

SCHEMA = "url string, at timestamp, value string, src string"


def T(day, hour):
    return datetime.datetime(2026, 1, day, hour)


def feed(spark, tmp_path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/b={i}"))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/b=*"))


def run(df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_first_sight_of_a_link(spark, tmp_path):
    stream = feed(spark, tmp_path, [[("a", T(1, 1), "x", "s"), ("a", T(1, 2), "y", "s")], [("a", T(2, 1), "x", "s"), ("b", T(2, 2), "x", "s")]])
    got = run(incremental.first_sight(stream, "url", "at"), tmp_path, "seen")
    assert sorted(r["url"] for r in got.collect()) == ["a", "b"]


def test_value_changes(spark, tmp_path):
    """A row that comes late, but within the watermark, makes no false change; the last rows wait for the watermark."""
    stream = feed(spark, tmp_path, [[("a", T(1, 1), "x", "s"), ("a", T(1, 3), "y", "s")], [("a", T(1, 2), "x", "s"), ("a", T(1, 4), "y", "s")], [("b", T(2, 1), "q", "s")], [("b", T(2, 12), "q", "s")], [("c", T(3, 12), "q", "s")]])
    got = run(incremental.value_changes(stream, "url", "at", "value"), tmp_path, "changes")
    assert [tuple(r) for r in got.where("key = 'a'").orderBy("at").select("at", "was", "now").collect()] == [(T(1, 1), None, "x"), (T(1, 3), "x", "y")]
    assert [tuple(r) for r in got.where("key = 'b'").select("was", "now").collect()] == [(None, "q")]


def test_hourly_counts(spark, tmp_path):
    stream = feed(spark, tmp_path, [[("a", T(1, 1), "x", "s"), ("b", T(1, 1), "x", "s")], [("c", T(1, 9), "x", "s")], [("d", T(1, 20), "x", "s")]])
    got = run(incremental.hourly(stream, "at", "src"), tmp_path, "hours").select(F.col("window.start").alias("h"), "n")
    assert [tuple(r) for r in got.orderBy("h").collect()][0] == (T(1, 1), 2)
