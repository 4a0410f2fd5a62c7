import random
import re
from collections import Counter, defaultdict
from hashlib import md5

from agendario.llm import quality_rules

from . import cases


def brute(rows, limit):
    """rows: (doc_id, source, text)."""
    normal = []
    for d, s, t in rows:
        pieces = [re.sub(" +", " ", re.sub(r"[\t\x0b\x0c\r]", " ", x)).strip(" ") for x in (t or "").lower().split("\n")]
        normal.append([(md5(x.encode()).digest(), len(x.split(" "))) for x in pieces if x])
    seen = defaultdict(set)
    for (d, s, t), lines in zip(rows, normal):
        for h, _ in lines:
            seen[s, h].add(t or "")
    out = []
    for (d, s, t), lines in zip(rows, normal):
        w = cases.words_of(t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        many = Counter(windows)
        repeat = {i + k for i, x in enumerate(windows) if many[x] > 1 for k in range(5)}
        own = [x for x in (t or "").split("\n") if cases.words_of(x)]
        removed = sum(n for h, n in lines if len(seen[s, h]) >= limit)
        failed = len(w) < 10 or 100 * len(repeat) > 20 * len(w)
        kept = not failed and len(w) - removed >= 10 and 100 * (len(w) - removed) >= 20 * len(w)
        out.append((d, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(repeat), failed, kept, removed))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    for limit in (2, 5):
        got = quality_rules.assess(docs, max_documents=limit).select(*quality_rules.COLUMNS)
        assert cases.rows_of(got) == brute(rows, limit)
    assert any(r[-1] for r in brute(rows, 5)), "the footer line counts"


def test_copies_do_not_make_their_own_lines_boilerplate(spark):
    text = cases.texts()[3]
    docs = cases.documents(spark, [(1000 + k, text, "en", "copies") for k in range(40)])
    kept = {r["doc_id"] for r in quality_rules.assess(docs).where("kept").collect()}
    assert {1000 + k for k in range(40)} <= kept


def test_a_line_of_many_different_documents_is_removed_whatever_else_they_share(spark):
    rng = random.Random(8)
    menu = [cases.prose(rng, 6).replace("\n", " ") for _ in range(20)]
    pages = ["\n".join([*menu, f"own line of page {k}"]) for k in range(100)]
    few = ["\n".join([*menu[:2], f"rare line of page {k} " + cases.prose(rng, 30)]) for k in range(19)]
    docs = cases.documents(spark, [(1000 + k, t, "en", "menu") for k, t in enumerate(pages)] + [(2000 + k, t, "en", "few") for k, t in enumerate(few)])
    got = {r["doc_id"]: r for r in quality_rules.assess(docs).where("doc_id >= 1000").collect()}
    assert all(got[1000 + k]["removed_words"] == 120 and not got[1000 + k]["kept"] for k in range(100))
    assert all(got[2000 + k]["removed_words"] == 0 and got[2000 + k]["kept"] for k in range(19))


def test_cleaned_drops_only_boilerplate_lines(spark):
    docs = cases.documents(spark)
    got = {r["doc_id"]: r["text"] for r in quality_rules.cleaned(docs, max_documents=5).collect() if r["doc_id"] is not None}
    for r in docs.where("doc_id is not null and text is not null").collect():
        lines = r["text"].split("\n")
        assert got[r["doc_id"]] in (r["text"], "\n".join(x for x in lines if x != "Shared line of a footer."))
    assert any("Shared line of a footer." in (r["text"] or "") and "Shared" not in got[r["doc_id"]] for r in docs.collect() if r["doc_id"])


def test_stage_keeps_columns_and_empty_table(spark):
    docs = cases.documents(spark)
    got = quality_rules.stage(spark, docs, "")
    assert got.columns == docs.columns and 0 < got.count() < docs.count()
    assert quality_rules.stage(spark, cases.empty(spark), "").collect() == []
    assert quality_rules.assess(cases.empty(spark)).collect() == []
