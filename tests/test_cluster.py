import datetime
import random
import re

import pyarrow as pa
import pytest

from agendario.functions.similarity import lcs
from agendario.operators import cluster, matching, simjoin
from agendario.operators.matching import Rules

DAY = datetime.date
RULES = Rules(
    generic=frozenset(["banda", "jam session"]), kinds=frozenset(["sala", "club"]), never_same=frozenset([frozenset(["sala sol", "sala sola"])]),
    common=frozenset("the la el los de del a y and with trib tributo tribute gran concierto band en trio club sala jazz jam session fest festival tour gira".split()),
)


def key(t):
    return re.sub("[^a-z0-9]+", " ", t.lower().replace("&", " and ").replace("'", "")).strip()


def ratio(a, b):
    return 100.0 if a == b else 200.0 * lcs(a, b) / (len(a) + len(b))


def plain_forms(name):
    k = key(name)
    m = re.match(rf"^(.*?) (?:{'|'.join(RULES.turns)}) ", f" {k} ")
    words = "|".join(w + (r"\.?" if w in ("feat", "ft") else "") for w in RULES.between)
    parts = [key(p) for p in re.split(rf"(?i)\s*(?:[.:|–—&+]|\s-\s|\b(?:{words})\b)\s*", name)]
    return {f for f in [k, (m.group(1).strip() if m else "") or k, *[p for p in parts if len(p) >= 4]] if f}


def plain_alike(a, b):
    """Two names, by the rules one after the other."""
    x, y = key(a), key(b)
    if x == y:
        return bool(x)
    short, long = sorted((x, y), key=lambda k: (len(k), k))
    inside = f" {short} " in f" {long} "
    if any(k in RULES.generic or len(k) < 3 for k in (x, y)):
        return inside and len(short) >= 4
    if x.replace(" ", "") == y.replace(" ", "") and len(x.replace(" ", "")) >= 3:
        return True
    for s in plain_forms(a):
        for t in plain_forms(b):
            if (s == t) if min(len(s), len(t)) < 4 else ratio(s, t) >= 90:
                return True
    if len(short) < 4 or not inside:
        return False
    return len(short.replace(" ", "")) >= 5 or bool(re.fullmatch("([a-z0-9] ){2,}[a-z0-9]", short)) or (long.startswith(short + " ") and len(short) >= 5 and len(short) >= 0.35 * len(long))


def plain_same_venue(a, b):
    if a == b:
        return True
    if frozenset((a, b)) in RULES.never_same:
        return False
    x, y = (" ".join(w for w in v.split() if w not in RULES.kinds) or v for v in (a, b))
    return ratio(x, y) >= 90 or x.replace(" ", "") == y.replace(" ", "") or ratio(" ".join(sorted(x.split())), " ".join(sorted(y.split()))) >= 92


def plain_lev(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(now[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def plain_act(a, b, venue):
    """Whether two headliners are one act at a venue: telling words of each, and how much of the smaller set is in the other."""
    def split(k):
        rest = [w for w in dict.fromkeys(key(k).split()) if len(w) >= 3 and w not in venue.split()]
        return [w for w in rest if w not in RULES.common and not w.isdigit()], sorted(w for w in rest if w not in RULES.articles)

    (x, bx), (y, by) = split(a), split(b)
    if not x or not y:
        return bx == by and len(bx) >= 2
    if not set(x) & set(y):
        return False
    x, y = sorted((x, y), key=len) if len(x) != len(y) else (x, y)
    soft = 0.0
    for w in x:
        best = 0.0
        for v in y:
            near = 1 - plain_lev(w, v) / max(len(w), len(v))
            best = max(best, 1.0 if w == v else near if min(len(w), len(v)) >= 4 and near >= 0.7 else 0.0)
        soft += best
    return soft / min(2, len(x)) >= RULES.least_act


def plain_festival(name, flag):
    t = re.sub(r"\([^)]*\)", " ", name)
    if not re.search(r"(?i)(^|[^a-z])fest(ival)?([^a-z]|$)", t):
        if not flag:
            return None
        t += " festival"
    return " ".join(sorted({w for w in key(t).split() if w not in RULES.festival_words and not re.match(r"^(\d+|[ivx]+)$", w)})) or None


def plain_first_fit(rows):
    """Sequential first fit over a day's rows, as the operator's description has it."""
    found, first = [], {}
    for r in sorted(rows, key=lambda r: (r["priority"], r["venue"] == "", r["row_id"])):
        names = [n for n in r["names"] if n and key(n)]
        if not names:
            continue
        mark = (tuple(names), r["venue"], r["priority"], r["minutes"], r["source"], r["url"], r["institution"], r["festival"])
        if mark in first:
            first[mark].append(r["row_id"])
            continue
        first[mark] = [r["row_id"]]
        r = r | {"names": names}
        for c in found:
            venues = [o["venue"] for o in c if o["venue"]]
            if r["venue"] and venues and not any(plain_same_venue(r["venue"], v) for v in venues):
                continue
            own = [o for o in c if r["source"] is not None and o["source"] == r["source"]]
            if r["minutes"] is not None and set(key(names[0]).split()) & set(RULES.sessions) and any(o["minutes"] not in (None, r["minutes"]) for o in own):
                continue
            if r["institution"] and r["url"] and any(o["url"] and o["url"] != r["url"] for o in own):
                continue
            k = plain_festival(names[0], r["festival"])
            if any(plain_alike(names[0], n) for o in c for n in o["names"]) or any(plain_alike(c[0]["names"][0], n) for n in names) or (k and any(plain_festival(o["names"][0], o["festival"]) == k for o in c)):
                c.append(r)
                break
            if r["venue"] and venues and any(key(o["names"][0]) != key(names[0]) and plain_act(names[0], o["names"][0], r["venue"]) and not (r["minutes"] is not None and o["minutes"] is not None and abs(r["minutes"] - o["minutes"]) > 120) for o in c):
                c.append(r)
                break
        else:
            found.append([r])
    whole = {}
    for c in found:
        ids = [i for r in c for i in first[(tuple(r["names"]), r["venue"], r["priority"], r["minutes"], r["source"], r["url"], r["institution"], r["festival"])]]
        whole |= {i: min(r["row_id"] for r in c) for i in ids}
    return whole | {r["row_id"]: r["row_id"] for r in rows if r["row_id"] not in whole}


SCHEMA = "row_id long, day date, names array<string>, venue string, priority int, minutes int, source string, url string, institution boolean, festival boolean"
ACTS = """Kings of Noise|King of Noise|Los de Siempre|Gira: Los de Siempre|siempre|Banda|banda|Sol Fest 2026|Festival Sol (A, B)|Sol|Matinee Kids|Matinee kids show|U2|U2 gira|The The|Maria Lopez|Maria Lopez Trio|
abc def ghi|P.H.A.T.|Jazz con sabor: P.H.A.T. (Italia)|Caro Caxi|Caro Taxi|OBK|Concierto OBK|Jam Session|Blues Jam Session|jam jazz session|Guest Act|Alpha|Omega|Deep Purple + Jayler|Deep Purple|Red Blue Green|Green Blue Yellow|rem|REM tour||???""".split("|")
VENUES = ["", "", "sala sol", "sol", "sala sola", "club luna", "luna", "lunas", "teatro real", "real teatro"]


def random_rows(n, seed):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        names = [rng.choice(ACTS).strip() for _ in range(rng.choice([1, 1, 1, 2, 3]))]
        out.append((k, DAY(2026, 5, 1 + k % 4), names, rng.choice(VENUES), rng.randint(1, 4), rng.choice([None, 1080, 1200, 1260, 1380]), rng.choice([None, "a", "b", "c"]), rng.choice([None, "u1", "u2"]), rng.random() < 0.2, rng.random() < 0.1))
    return out


@pytest.mark.parametrize("seed, n", [(1, 300)])
def test_clusters_equal_sequential_first_fit(spark, seed, n):
    rows = random_rows(n, seed)
    rows += [(1000 + i, *rows[i][1:]) for i in range(0, n, 5)]
    got = {r[0]: r[1] for r in cluster.clusters(spark.createDataFrame(rows, SCHEMA), ["day"], RULES).collect()}
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    dicts = [dict(zip(names, r)) for r in rows]
    want = {}
    for day in {r[1] for r in rows}:
        want |= plain_first_fit([d for d in dicts if d["day"] == day])
    assert {k: (got[k], v) for k, v in want.items() if got.get(k) != v} == {}
    assert len(got) == len(rows) and len(set(got.values())) < 0.8 * len(rows)


#: The announcements (names, venue, minutes, source, url, institution) of a day each, and how they part.
GUARDS = [
    # A shared support act joins nothing; a headliner among the other's guests does.
    ([(["Alpha", "Guest Act"], "sol", 1200, "x", None, False), (["Omega", "Guest Act"], "sol", 1230, "y", None, False)], [[0], [1]]),
    ([(["Deep Purple", "Jayler"], "sol", 1200, "x", None, False), (["Jayler", "Deep Purple"], "sol", 1230, "y", None, False)], [[0, 1]]),
    # Sessions: only one source's other hour is another showing; an unknown hour joins.
    ([(["Wicked, el musical"], "sol", 960, "x", None, False), (["Wicked, el musical"], "sol", 1200, "x", None, False)], [[0], [1]]),
    ([(["Wicked, el musical"], "sol", 960, "x", None, False), (["Wicked, el musical"], "sol", 1200, "y", None, False), (["Wicked, el musical"], "sol", None, "x", None, False)], [[0, 1, 2]]),
    # Hours only count for an act under another name.
    ([(["Kings of Noise"], "sol", 1080, "x", None, False), (["King of Noise"], "sol", 1380, "y", None, False)], [[0, 1]]),
    ([(["Emma Swift"], "sol", 1080, "x", None, False), (["An evening: Luther, Emma Swift-Russell"], "sol", 1380, "y", None, False), (["Swift Emma"], "sol", 1100, "z", None, False)], [[0, 1, 2]]),
    ([(["Caro Caxi"], "sol", 1080, "x", None, False), (["Caro Taxi"], "sol", 1380, "y", None, False)], [[0], [1]]),
    # An institution's other page is another act.
    ([(["Coro Norte"], "sol", 1200, "i", "p1", True), (["Coro Norte"], "sol", 1200, "i", "p2", True)], [[0], [1]]),
    ([(["Coro Norte"], "sol", 1200, "i", "p1", False), (["Coro Norte"], "sol", 1200, "i", "p2", False)], [[0, 1]]),
    # One name at two venues, with one that names no venue: it goes to the first.
    ([(["Alpha"], "sol", None, "x", None, False), (["Alpha"], "luna", None, "y", None, False), (["Alpha"], "", None, "z", None, False)], [[0, 2], [1]]),
    # A title with its cycle in front, initials with dots, a longer name in the same place.
    ([(["LOS VINAGRES"], "sol", 1260, "x", None, False), (["Las Noches de Río Babel. Los Vinagres"], "sol", 1260, "y", None, False)], [[0, 1]]),
    ([(["P.H.A.T"], "sol", 1260, "x", None, False), (["JAZZ CON SABOR A CLUB 26: P.H.A.T. (ITALIA)"], "sol", None, "y", None, False)], [[0, 1]]),
    ([(["Mikky Dee"], "sol", None, "x", None, False), (["MIkkey Dee & Friends"], "sol", 1200, "y", None, False)], [[0, 1]]),
    ([(["Tom & Jerry"], "sol", 1260, "x", None, False), (["Tom Waits"], "sol", None, "y", None, False)], [[0], [1]]),
]


def test_guards(spark):
    rows = [(100 * d + i, DAY(2026, 5, 1) + datetime.timedelta(d), n, v, 3, m, s, u, inst, False) for d, (day, _) in enumerate(GUARDS) for i, (n, v, m, s, u, inst) in enumerate(day)]
    parts = {}
    for r in cluster.clusters(spark.createDataFrame(rows, SCHEMA), ["day"], RULES).collect():
        parts.setdefault(r.cluster_id, []).append(r.row_id)
    for d, (_, want) in enumerate(GUARDS):
        assert sorted(sorted(i % 100 for i in p) for c, p in parts.items() if c // 100 == d) == want, GUARDS[d]


ACT_CASES = [
    ("the doors are open trib the doors", "el gran tributo a the doors", "", True), ("emma swift aust usa", "emma swift with luther russell", "", True), ("caro caxi", "caro taxi", "", True),
    ("obk", "concierto obk", "", True), ("sim", "silence iz mine sim", "", True), ("tributo a queen", "tributo a mecano", "", False), ("black birds", "the black crowes", "", False),
    ("intruso jazz session", "intruso acid jam", "intruso", False), ("jam session jazz", "jazz jam session", "", True), ("jazz jam", "jazz session", "", False), ("one two", "red blue", "sala", False), ("maria lopez trio", "maria lopez", "sala sol", True),
]


def test_acts_under_other_names(spark):
    rows = [(k, h, venue or "nowhere", 1) for k, (a, b, venue, _) in enumerate(ACT_CASES) for h in (a, b)]
    got = {(r.b, r.h, r.o) for r in matching.acts_near(spark.createDataFrame(rows, "b long, h string, v string, place long"), RULES).collect()}
    assert got == {(k, *p) for k, (a, b, _, same) in enumerate(ACT_CASES) if same for p in ((a, b), (b, a))}
    assert all(plain_act(a, b, venue) == same for a, b, venue, same in ACT_CASES)


@pytest.mark.parametrize("least, letters", [(90, "abcd "), (92, "ab"), (75, "abc"), (100, "ab")])
def test_similarity_join_against_all_pairs(spark, least, letters):
    rng = random.Random(least)
    texts = [(rng.randint(1, 2), "".join(rng.choice(letters) for _ in range(rng.randint(0, 16)))) for _ in range(150)]
    for k, t in texts[:100]:
        for _ in range(2):
            i = rng.randint(0, len(t))
            texts.append((k, t[:i] + rng.choice(["", rng.choice(letters)]) + t[i + rng.randint(0, 1):]))
    df = spark.createDataFrame(texts, "k int, s string")
    got = {(r.k, r.a, r.b): r.ratio for r in simjoin.alike(df, df, ["k"], float(least)).collect()}
    one = sorted(set(texts))
    want = {(k, a, b): ratio(a, b) for k, a in one for j, b in one if j == k and a and b and ratio(a, b) >= least}
    assert got == pytest.approx(want) and set(got) == set(want)


def test_venues(spark):
    names = ["sala el sol", "el sol", "sol teatro", "teatro sol", "sala sol", "sala sola", "sala", "", "luna", "l una", "club"]
    got = {(r.v, r.w) for r in matching.venues_near(spark.createDataFrame([(n,) for n in names], "v string"), RULES).collect()}
    assert got == {(a, b) for a in names for b in names if a and b and plain_same_venue(a, b)}


def test_no_rows_and_no_names(spark):
    assert cluster.clusters(spark.createDataFrame([], SCHEMA), ["day"], RULES).collect() == []
    assert [tuple(r) for r in cluster.clusters(spark.createDataFrame([(5, DAY(2026, 5, 1), [], None, 1, None)], "row_id long, day date, names array<string>, venue string, priority int, minutes int"), ["day"]).collect()] == [(5, 5)]


def test_a_call_keeps_its_groups_apart():
    def row(group, row_id):
        return {"group": group, "kind": "row", "row_id": row_id, "keys": ["ana"], "h": "ana", "v": "sol", "ws": "ana", "priority": 1, "minutes": None, "source": None, "url": None, "institution": False, "session": False, "fest": None, "list": None}

    def near(group, kind, **key):
        return row(group, None) | {"kind": kind, "list": ["ana" if kind != "venue" else "sol"]} | key

    rows = [row(g, 10 * g + k) for g in (1, 2) for k in (1, 2)] + [near(g, kind) for g in (2, 1) for kind in ("name", "act", "venue")]
    got = cluster._first_fit(120)(pa.Table.from_pylist(rows)).to_pylist()
    assert sorted((r["first"], r["cluster_id"]) for r in got) == [(11, 11), (12, 11), (21, 21), (22, 21)]
