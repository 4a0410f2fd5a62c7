import random
import re

from agendario.operators import positions


def key(t):
    return re.sub("[^a-z0-9]+", " ", t.lower().replace("&", " and ").replace("'", "")).strip()


def plain_places(text, phrase):
    return [m.start() for m in re.finditer(f"(?<![a-z0-9])(?={re.escape(phrase)}(?![a-z0-9]))", text)]


def plain_near(docs, claims, reach):
    out = {}
    for d, t in docs:
        for c, name, phrase in claims:
            n, p, t2 = key(name), key(phrase), key(t or "")
            if not n or not p:
                continue
            gaps = [max(0, a - b - len(n), b - a - len(p)) for a in plain_places(t2, p) for b in plain_places(t2, n)]
            if gaps and min(gaps) <= reach:
                out[d, c] = min(gaps)
    return out


def test_near_names_against_scan(spark):
    rng = random.Random(3)
    words = ["Luna", "sol", "de", "Mar", "rock", "20:30", "12 €", "&", "gira", "x"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 80)))) for i in range(120)] + [(200, None), (201, "¡Sol!"), (202, "")]
    claims = [(1, "Luna", "20 30"), (2, "sol de mar", "rock"), (3, "Luna", "Luna sol"), (4, "sol", "sol"), (5, "", "x"), (6, "none such", "x"), (7, "de de", "Rock rock"), (8, "Mar", "20:30 12")]
    d, c = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(claims, "claim int, name string, phrase string")
    for reach in (0, 12, 600):
        got = {(r.doc_id, r.claim): r.distance for r in positions.near_names(d, "doc_id", "text", c, reach).collect()}
        assert got == plain_near(docs, claims, reach) and len(got) > 20
