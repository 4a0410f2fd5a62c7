import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from agendario.functions import keys, text
from agendario.operators import dictionary


def lines(texts):
    return [x for _, k in keys.keys(pa.array(texts, pa.string())) for x in k.whole().to_pylist()]


def test_every_letter_against_norm_key(spark):
    letters = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f"A{c}b {c}" for c in letters] + ["".join(letters[i : i + 97]) for i in range(0, len(letters), 97)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", text.norm_key(F.col("t")).alias("n"))
    want = [r.n for r in df.orderBy("k").collect()]
    assert [(t, a, b) for t, a, b in zip(texts, lines(texts), want) if a != b] == []


def test_odd_texts_in_pieces(spark, monkeypatch):
    rng = random.Random(5)
    parts = ["&", " & ", "'", "’", "´", "`", "Ñ", "ß", "日本", "🎸", " ", "\n", "--", "a", "Rock", "2º", "K", ""]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300)] + [None, "", "&", "x&", "&x", "' '", "\x00\x01a\x01"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", F.coalesce(text.norm_key(F.col("t")), F.lit("")).alias("n"))
    want = [r.n for r in df.orderBy("k").collect()]
    for piece in (1, 50, 1 << 19):
        monkeypatch.setattr(keys, "PIECE", piece)
        assert lines(texts) == want
    assert lines([]) == [] and [x for _, k in keys.keys(pa.array(texts, pa.string()).slice(7, 20)) for x in k.whole().to_pylist()] == want[7:27]


def test_windows_have_the_digests_of_their_words(monkeypatch):
    monkeypatch.setattr(keys, "WINDOWS", 3)
    column = pa.array(["a b, a b", None, "", "b a b c", "c"])
    (_, k), = keys.keys(column)
    for n in (1, 2, 3):
        seen = {}
        for a, digests in k.windows(n):
            for first, digest in zip(range(a, a + len(digests)), digests):
                if len(k.within(np.array([first]), n)[0]):
                    seen.setdefault(k.cut(np.array([first]), np.array([first + n - 1]))[0].as_py(), set()).add(int(digest))
        assert set(seen) == {1: {"a", "b", "c"}, 2: {"a b", "b a", "b c"}, 3: {"a b a", "b a b", "a b c"}}[n]
        assert all(len(d) == 1 for d in seen.values()) and len(set.union(*seen.values())) == len(seen)


def test_phrases_with_one_digest_are_told_apart(spark, monkeypatch):
    """Whatever the digests are, phrases themselves decide: here all of them are alike, and the workers compare."""
    known = pa.table({"phrase": ["a b", "c d", "e f"], "digest": pa.array([7, 7, 9], pa.int64())})
    told = dictionary._Shared(known)
    said = pa.array(["c d", "a b", "x y", "e f", "e f", "a b"])
    got = told.which(np.array([7, 7, 7, 9, 7, 10], np.uint64), said)
    assert [told.phrases[int(i)].as_py() if i >= 0 else None for i in got] == ["c d", "a b", None, "e f", None, None]


def test_three_ways_give_the_same_rows(spark, monkeypatch):
    rng = random.Random(11)
    words = ["rock", "Índie", "pop", "R&B", "o'clock", "20:30"]
    rows = spark.createDataFrame([(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for k in range(80)] + [(900, None), (901, "")], "k int, t string")
    names = spark.createDataFrame([(" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))),) for _ in range(40)], "p string")
    for longest in (False, True):
        ways = []
        for most, shared in ((dictionary.MOST, dictionary.SHARED), (1, dictionary.SHARED), (1, 0)):
            monkeypatch.setattr(dictionary, "SHARED", shared)
            ways.append(sorted(map(tuple, dictionary.phrases_in(rows, "k", "t", names, "p", longest, most).collect())))
            monkeypatch.undo()
        assert ways[0] == ways[1] == ways[2] and len(ways[0]) > 100
    assert {r.phrase for r in dictionary.openings(rows, "t", 3).collect()} == {r.p for r in rows.select(F.array_join(F.slice(F.split(text.norm_key(F.col("t")), " "), 1, 3), " ").alias("p"), F.size(F.split(text.norm_key(F.col("t")), " ")).alias("n")).where("n >= 3").collect()}


def test_many_phrases_are_found_without_keys_in_the_jvm_or_a_join(spark, monkeypatch):
    names, real = [], dictionary.written
    monkeypatch.setattr(dictionary, "written", lambda df, name: names.append(name) or real(df, name))
    monkeypatch.setattr(dictionary, "norm_key", None)
    docs = spark.range(300).selectExpr("id AS k", "concat('Uno dos ', id % 50, ' tres') AS t")
    phrases = spark.range(50).selectExpr("concat('dos ', id) AS p")
    found = dictionary.phrases_in(docs, "k", "t", phrases, "p", longest=False, most=5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 300 and names == ["phrases"] and "Join" not in plan and "Exchange" not in plan, plan
