import hashlib
import random
import zlib

import numpy as np
import pytest

from agendario.llm import periodic

from . import cases


def brute_runs(words, least=24, times=3):
    """Every run by its definition: all periods, all maximal stretches, the smallest period of each stretch."""
    n, found = len(words), set()
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            s, e = i, j + p
            if j > i and e - s >= max(least, times * p) and not any(all(words[k] == words[k + q] for k in range(s, e - q)) for q in range(1, p)):
                found.add((s, e - s, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = planted(doc_id, cases.words_of(text))
    runs = brute_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    tail = (digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)))
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], *tail)


def some_words(rng):
    """Words with planted repeats, repeats in repeats, and few letters so that chance repeats occur."""
    out = []
    for _ in range(rng.randint(1, 5)):
        piece = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
        kind = rng.random()
        if kind < 0.5:
            out += piece * rng.randint(2, 9) + piece[: rng.randint(0, len(piece))]
        elif kind < 0.7:
            out += (piece * 12 + ["x"]) * rng.randint(1, 4)
        else:
            out += piece
    return out


@pytest.mark.parametrize("least, times", [(24, 3), (5, 3), (9, 4)])
def test_runs_as_by_definition(least, times):
    rng = random.Random(least)
    texts = [" ".join(some_words(rng)) for _ in range(150)] + ["", "a", "a " * 200, "a b " * 150, None, "a b c " * 9]
    counts, runs, collapsed = periodic._worked(texts, least, times)
    for text, n, found, rest in zip(texts, counts, runs, collapsed):
        words = cases.words_of(text)
        assert n == len(words)
        assert found == brute_runs(words, least, times), text
        gone = {i for s, m, p in found for i in range(s + p, s + m)}
        assert rest.decode() == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_small_chunks_and_collisions(monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(some_words(rng)) for _ in range(60)]
    plain = periodic._worked(texts, 24, 3)[1]
    monkeypatch.setattr(periodic, "PAIRS", 16)
    assert periodic._worked(texts, 24, 3)[1] == plain
    monkeypatch.setattr(periodic, "PRIME", 7)
    assert periodic._worked(texts, 24, 3)[1] == plain
    numbers = [np.array([ord(w) for w in t.split()]) for t in texts]
    assert [periodic.plain_runs(w, 24, 3) for w in numbers] == [sorted(r) for r in plain]


def test_very_long_text():
    rng = random.Random(2)
    words = [str(rng.randrange(5000)) for _ in range(120_000)]
    words[70_000:110_000] = (words[70_000:71_000] * 40)
    assert periodic._worked([" ".join(words)], 24, 3)[1] == [brute_of_one(words, 70_000, 110_000, 1000)]


def brute_of_one(words, s, e, p):
    while s and words[s - 1] == words[s - 1 + p]:
        s -= 1
    while e < len(words) and words[e] == words[e - p]:
        e += 1
    return [(s, e - s, p)]


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(4)
    extra = [(1000 + i, " \t".join(some_words(rng)), "en", "s") for i in range(80)] + [(2000, "\x1c\x85 tokay y " * 40, "en", "s")]
    docs = cases.documents(spark, extra)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = periodic.op12_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [expected(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert cases.rows_of(got) == sorted(want, key=repr)
    assert sum(r[1] > 0 for r in want) > 20


def test_empty_table_and_own_columns(spark):
    assert periodic.detect(cases.empty(spark)).collect() == []
    rows = periodic.detect(spark.createDataFrame([("k", "a b " * 20, 1)], "id string, body string, runs int"), "id", "body").collect()
    assert [(r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows] == [("k", 40, [(0, 40, 2)], "a b")]
