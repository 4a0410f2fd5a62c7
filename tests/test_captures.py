import json

from agendario.sources import captures


def write(folder, source, stamp, pages):
    (folder / source).mkdir(parents=True, exist_ok=True)
    (folder / source / f"{stamp}.jsonl").write_text("\n".join(json.dumps({"url": u, "html": h}) for u, h in pages) + "\n")


def test_batch_and_stream_agree(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a", "2026-01-01", [("u1", "<p>é</p>"), ("u2", None)])
    write(folder, "b", "2026-01-01", [("u3", "x\ny")])
    captures.register(spark)
    batch = spark.read.format("captures").load(str(folder))
    assert batch.rdd.getNumPartitions() == 2
    only = batch.where("source = 'b'")
    assert only.rdd.getNumPartitions() == 1 and [r.url for r in only.collect()] == ["u3"]
    assert sorted(r.url for r in batch.where("source IN ('a', 'c') AND html IS NOT NULL").collect()) == ["u1"]

    def step():
        q = spark.readStream.format("captures").load(str(folder)).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
        q.awaitTermination()
        return sorted((tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()), key=repr)

    assert step() == sorted((tuple(r) for r in batch.collect()), key=repr)
    write(folder, "a", "2026-01-02", [("u1", "new")])
    write(folder, "c", "2026-01-03", [])
    assert step() == sorted((tuple(r) for r in spark.read.format("captures").load(str(folder)).collect()), key=repr)
    assert len(step()) == 4
    assert spark.read.format("captures").load(str(tmp_path / "none")).collect() == []
