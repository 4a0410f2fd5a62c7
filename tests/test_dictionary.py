import random
import re

from agendario.operators import dictionary


def key(t):
    return re.sub("[^a-z0-9]+", " ", t.lower().replace("&", " and ").replace("'", "")).strip()


def plain(text, phrases, longest):
    text = f" {key(text)} "
    hits = sorted(((m.start(), m.start() + len(p), p) for p in phrases for m in re.finditer(f"(?<= )(?={re.escape(p)} )", text)), key=lambda h: (h[0], -h[1]))
    out, free = [], 0
    for a, b, p in hits:
        if not longest or a >= free:
            out.append((p, a - 1))
            free = b
    return sorted(out)


def test_both_ways_against_plain_search(spark):
    rng = random.Random(7)
    words = ["rock", "indie", "pop", "alternative", "hard", "soul & funk", "r'n'b", "a", "aa"]
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(150)] + [(900, None), (901, "ROCK!!")]
    names = {" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(60)} | {"Rock", "", "not there"}
    rows, known = spark.createDataFrame(texts, "k int, t string"), spark.createDataFrame([(n,) for n in names], "name string")
    phrases = {key(n) for n in names} - {""}
    for longest in (True, False):
        want = sorted((k, *h) for k, t in texts if t for h in plain(t, phrases, longest))
        for most in (dictionary.MOST, 5):
            got = dictionary.phrases_in(rows, "k", "t", known, "name", longest, most).collect()
            assert sorted(map(tuple, got)) == want
    assert dictionary.phrases_in(rows, "k", "t", known.limit(0), "name").collect() == []


def test_categories(spark):
    exact = spark.createDataFrame([("Pop", ["pop indie", "pop"]), ("Folk", ["folk"]), ("Blues/RNB", ["blues"]), ("Pop / Rock", ["pop", "rock"])], "name string, categories array<string>")
    keywords = spark.createDataFrame([(1, "hard rock", "metal"), (2, "rock", "rock"), (3, "indie", "pop indie"), (4, "roll", "rock")], "pos int, phrase string, category string")
    said = {1: "Pop", 2: "Indie Rock, Folk", 3: "blues / rnb", 4: "Teatro - Hard Rock - rock", 5: "nothing", 6: None, 7: "folk", 8: "Pop / Rock", 9: "x; indie", 10: ""}
    got = {r.k: (r.category, r.categories) for r in dictionary.categories(spark.createDataFrame(list(said.items()), "k int, style string"), "k", "style", exact, keywords).collect()}
    assert got == {
        1: ("pop indie", ["pop indie", "pop"]), 2: ("rock", ["rock", "folk"]), 3: ("blues", ["blues"]), 4: ("metal", ["metal", "rock"]), 5: (None, []), 6: (None, []), 7: ("folk", ["folk"]), 8: ("pop", ["pop", "rock"]), 9: ("pop indie", ["pop indie"]), 10: (None, []),
    }


def test_title_rules(spark):
    rules = spark.createDataFrame([(1, "Coro de", "classical", "Choral"), (2, "coro", "other", None), (3, "candlelight", "other", None)], "pos int, phrase string, grp string, style string")
    rows = spark.createDataFrame([(1, "Gran coro de Castañuelas"), (2, "CORO"), (3, "corona"), (4, None)], "k int, t string")
    got = {r.k: (r.grp, r.style) for r in dictionary.first_rule(rows, "k", "t", rules, ["grp", "style"]).collect()}
    assert got == {1: ("classical", "Choral"), 2: ("other", None), 3: (None, None), 4: (None, None)}
