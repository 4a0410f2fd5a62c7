import datetime
import random
import re

from pyspark.sql import functions as F

from agendario.sources import segments

TODAY = datetime.date(2026, 1, 10)
STOP = "entradas|comprar"


def plain_scan(texts, before):
    """A loop over (kind, text, day, front, hour): ``day`` for a text with a date."""
    out, used = [], set()
    for i, t in enumerate(texts):
        if t["day"] is None:
            continue
        title = t["front"]
        if title is None:
            for j in range(i - 1, max(-1, i - 5), -1) if before else range(i + 1, min(len(texts), i + 5)):
                if j in used or texts[j]["day"] is not None:
                    break
                if texts[j]["title"]:
                    title = texts[j]["text"]
                    used.add(j)
                    break
        if title is not None:
            hour = t["own"] or next((x["hour"] for x in texts[i + 1 : i + 4] if x["hour"]), None)
            out.append((i, t["day"], title, hour))
    return out


def piece(rng):
    day = datetime.date(2026, rng.randint(2, 9), rng.randint(1, 28))
    es = f"{day.day} de {segments.dates.MONTHS[day.month - 1]}"
    plain = {"day": None, "front": None, "own": None, "hour": None, "title": False}
    return rng.choice([
        plain | {"text": es, "day": day, "title": True}, plain | {"text": f"{day.day}/{day.month}/2026 21:30 h", "day": day, "own": "21:30", "title": True}, plain | {"text": f"Gran Artista - {es}", "day": day, "front": "Gran Artista", "title": True},
        plain | {"text": "Los Amados", "title": True}, plain | {"text": "Sho Hai & Co", "title": True}, plain | {"text": "Comprar"}, plain | {"text": "20:15", "hour": "20:15"}, plain | {"text": "a las 22:00 en punto", "hour": "22:00", "title": True}, plain | {"text": "***"},
    ])


def test_against_a_loop(spark):
    rng = random.Random(11)
    rows, want = [], {True: {}, False: {}}
    for k in range(150):
        texts = [piece(rng) for _ in range(rng.randint(0, 14))]
        html = "<header><p>Menu 3 de mayo</p></header>" + "".join(f"<{rng.choice(['p', 'b', 'td class=x'])}> {t['text'].replace('&', '&amp;')}\n</p>" for t in texts) + "<script>var x = '1 de mayo';</script>"
        rows.append((k, html))
        for before in want:
            want[before][k] = plain_scan(texts, before)
    pages = spark.createDataFrame([*rows, (900, None), (901, "")], "k int, html string")
    for before in want:
        got = {}
        for r in segments.dated_titles(pages, "k", "html", F.lit(TODAY), STOP, before).orderBy("k", "pos").collect():
            got.setdefault(r.k, []).append((r.pos, r.day, r.title, r.hour))
        assert got == {k: v for k, v in want[before].items() if v}
    assert re.search(segments.date_pattern(), "Oct 17, 2026")
