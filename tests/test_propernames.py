import random
import re
import unicodedata

from pyspark.sql import functions as F

from agendario.functions import propernames

WHO = ("grupo", "banda", "cantautor", "cantante", "duo", "trio")
FROM = ("argentino", "madrilena", "inglesa", "mexicano", "madrileno")


def key(t):
    t = "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower()
    return re.sub("[^a-z0-9]+", " ", re.sub("['’`´]", "", t.replace("&", " and "))).strip()


def plain_named_whole(text, name):
    parts = key(name).split()
    toks = re.findall(r"[^\W_]+(?:['’][^\W_]+)*|&|[^\w\s]", text.replace("&amp;", "&"))
    keys = ["and" if t == "&" else key(t) if re.match(r"[^\W_]", t) else None for t in toks]
    cap = [t[:1].isupper() or t[:1].isdigit() for t in toks]

    def part(j, step):
        linked = False
        while 0 <= j < len(toks) and ((keys[j] in propernames.LINKS and not cap[j]) or toks[j] in propernames.QUOTES):
            j, linked = j + step, True
        if j < 0:
            return linked and text[:1].islower()
        return j < len(toks) and bool(keys[j]) and cap[j]

    k = len(parts)
    return bool(parts) and any(keys[i : i + k] == parts and cap[i] and not part(i - 1, -1) and not part(i + k, 1) for i in range(len(toks) - k + 1))


CASES = [
    ("Megara es un grupo", "Megara", True), ("Diego Martín canta", "Martin", False), ("Mariah Carey en directo", "Carey", False), ("una noche de acid jazz", "Jazz", False), ("Kraak & Smaak", "Kraak", False), ("Kraak &amp; Smaak", "Smaak", False),
    ("Los Hijos de la Profecía", "Profecía", False), ("de la Profecía) fue una banda", "Profecía", False), ("Anoche tocó Profecía.", "profecia", True), ("Pablo “Tito” Rodríguez", "Tito", False), ("vuelve el “Tito” de siempre", "Tito", True), ("AC/DC y Kiss", "Kiss", False), ("con AC/DC, Kiss y más", "Kiss", True),
    ("", "X", False), ("Texto", "", False), ("Los 80", "80", False), ("El grupo U2, de Dublín", "U2", True), ("Banda O'Connor Trio", "OConnor", False), ("con la Banda Sur. Norte", "Norte", True),
]


def test_cases(spark):
    rows = spark.createDataFrame([(i, t, n) for i, (t, n, _) in enumerate(CASES)] + [(99, None, "x"), (98, "x", None)], "i int, t string, n string")
    got = {r.i: r.w for r in rows.select("i", propernames.named_whole(F.col("t"), F.col("n")).alias("w")).collect()}
    assert [got[i] for i in range(len(CASES))] == [w for *_, w in CASES] == [plain_named_whole(t, n) for t, n, _ in CASES]
    assert got[99] is None and got[98] is None


def test_generated_sentences(spark):
    rng = random.Random(6)
    words = ["Luna", "Sol", "luna", "sol", "de", "la", "Los", "y", "&", ",", ".", "“", "”", "canta", "O'Sol", "2", "Éxito", "the", "-", "(", ")"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))), " ".join(rng.choice(["Luna", "sol", "Éxito", "2", "Sol y Luna"]) for _ in range(rng.randint(1, 2)))) for _ in range(3000)]
    got = spark.createDataFrame(rows, "t string, n string").select("t", "n", propernames.named_whole(F.col("t"), F.col("n")).alias("w")).collect()
    assert [(r.t, r.n, r.w) for r in got if r.w != plain_named_whole(r.t, r.n)] == []
    assert 100 < sum(r.w for r in got) < 2900


def test_said_beside(spark):
    cases = [
        ("La banda madrileña Sho-Hai presenta su disco.", "Sho-Hai", ["madrilena"]), ("El cantautor argentino Kevin Johansen llega.", "Kevin Johansen", ["argentino"]), ("El grupo de rock argentino Los Amados vuelve.", "Los Amados", ["argentino"]),
        ("Mala Luna Band es un grupo madrileño", "Mala Luna Band", ["madrileno"]), ("Una noche de cocina italiana con Epical.", "Epical", []), ("Los Amados y The Bang, banda inglesa y grupo mexicano.", "Los Amados", []),
        ("por la banda inglesa y en 2018 Alchemy Project empezó a tocar.", "Alchemy Project", []), ("Martinez es un grupo mexicano", "Martin", []), ("x", "", []),
    ]
    rows = spark.createDataFrame([(i, t, n) for i, (t, n, _) in enumerate(cases)], "i int, t string, n string")
    got = {r.i: r.w for r in rows.select("i", propernames.said_beside(F.col("t"), F.col("n"), WHO, FROM).alias("w")).collect()}
    assert [got[i] for i in range(len(cases))] == [w for *_, w in cases]
    places = [("Compro Oro nace en Almería y toca", "Compro Oro", "almeria"), ("Thee Nameshakes, procedentes de Glasgow, Escocia.", "Thee Nameshakes", "glasgow escocia"), ("Otro grupo. Nace en Lima", "Otro grupo", None)]
    rows = spark.createDataFrame(places, "t string, n string, p string")
    assert all(r.p == r.w for r in rows.select("p", propernames.birthplace_said(F.col("t"), F.col("n")).alias("w")).collect())
    assert spark.range(1).select(F.size(propernames.sentences(F.lit("Una frase entera. Otra frase entera!\nNo.")))).first()[0] == 2
