import random
import re

import numpy as np

from agendario.llm import decontaminate

from . import cases

ITEMS = "item_id long, text string, doc_id string, score string"


def smith_waterman(a, b):
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(max(0, before[j] + (1 if x == y else -1), before[j + 1] - 1, now[-1] - 1))
        best, before = max(best, *now), now
    return best


def test_alignment_scores_against_the_plain_table():
    rng = np.random.default_rng(2)
    a = [rng.integers(0, 5, rng.integers(1, 40)).astype(np.uint64) for _ in range(60)]
    b = [rng.integers(0, 5, rng.integers(1, 25)).astype(np.uint64) for _ in range(60)]
    score, first, last = decontaminate.align(a, b)
    assert score.tolist() == [smith_waterman(x.tolist(), y.tolist()) for x, y in zip(a, b)]
    for x, y, s, lo, hi in zip(a, b, score, first, last):
        assert s == 0 or smith_waterman(x[lo:hi].tolist(), y.tolist()) == s


def edited(rng, text, share):
    words = text.split(" ")
    for _ in range(int(share * len(words))):
        k = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.6:
            words[k] = "other" + str(k)
        elif kind < 0.8:
            words.insert(k, "added")
        else:
            del words[k]
    return " ".join(words)


def test_planted_copies_are_found_and_clean_documents_left(spark):
    rng = random.Random(9)
    items = [cases.prose(rng, n).replace("\n", " ") for n in (18, 30, 45, 60)]
    own = [(i, t, "d", "s") for i, t in enumerate(items)] + [(None, None, "", ""), (77, "two words", "", ""), (3, items[3], "", "")]
    clean = [(2000 + k, cases.prose(rng, 120), "en", "c") for k in range(30)]
    planted, expected = [], set()
    for k in range(24):
        text = items[k % 4] if k < 8 else edited(rng, items[k % 4], 0.15)
        text = text.upper() if k % 5 == 0 else text
        planted.append((1000 + k, cases.prose(rng, 80) + " " + text + " " + cases.prose(rng, 50), "en", "p"))
        expected.add((1000 + k, k % 4))
    many = [(3000 + k, items[1] + " " + cases.prose(rng, 40), "en", "hot") for k in range(150)]
    expected |= {(r[0], 1) for r in many}
    docs = cases.documents(spark, planted + clean + many)
    got = decontaminate.contaminated(docs, spark.createDataFrame(own, ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)
    exact = {r["doc_id"]: r for r in got if r["doc_id"] in (1001, 1002, 1003)}
    assert all(r["score"] == r["n_words"] == r["end"] - r["start"] for r in exact.values())


def test_a_part_that_leaked_thousands_of_times_is_found_beside_a_few_whole_copies(spark):
    rng = random.Random(4)
    item = " ".join(f"item{k}" for k in range(40))
    start = " ".join(item.split(" ")[:19])
    whole = [(k, cases.prose(rng, 20) + " " + item, "en", "whole") for k in range(5)]
    parts = [(10 + k, cases.prose(rng, 15) + " " + start + " " + cases.prose(rng, 15), "en", "part") for k in range(2000)]
    phrase = [(5000 + k, cases.prose(rng, 15) + " item0 item1 item2 item3 " + cases.prose(rng, 15), "en", "phrase") for k in range(20)]
    # The rest of this copy is edited so that only grams of the common part are left.
    words = [w if k < 7 or k % 3 else "other" for k, w in enumerate(item.split(" "))]
    edited_copy = [(6000, cases.prose(rng, 15) + " " + " ".join(words), "en", "edited")]
    docs = cases.documents(spark, whole + parts + phrase + edited_copy)
    got = {r["doc_id"]: r["score"] for r in decontaminate.contaminated(docs, spark.createDataFrame([(1, item, "d", "s")], ITEMS)).collect()}
    assert got == {k: 40 for k in range(5)} | {10 + k: 19 for k in range(2000)} | {6000: smith_waterman(words, item.split(" "))}
    assert got[6000] < 40


def test_a_very_long_item_widens_no_passage_of_the_others(spark):
    rng = random.Random(6)
    short, long = cases.prose(rng, 20).replace("\n", " "), " ".join(f"long{k}" for k in range(3000))
    docs = spark.createDataFrame([(1, cases.prose(rng, 5000) + " " + short + " " + cases.prose(rng, 5000)), (2, "so " + long + " end"), (3, cases.prose(rng, 300))], "doc_id long, text string")
    items = decontaminate.item_words(spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")).selectExpr("item_id AS item", "words")
    found = decontaminate.passages(docs, decontaminate.item_grams(items)).collect()
    assert all(len(r["words"]) // 8 <= 400 for r in found if r["doc_id"] == 1)
    got = decontaminate.contaminated(docs, spark.createDataFrame([(1, short), (2, long)], "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"]) for r in got) == [(1, 1, 20), (2, 2, 3000)]


def corpus(seed):
    """Documents with whole, edited and partial items and stray grams of them; all items begin with the same question."""
    rng = random.Random(seed)
    items = ["which of the following is true about " + cases.prose(rng, n).replace("\n", " ") for n in (3, 9, 20, 34, 60)]
    docs = []
    for k in range(120):
        item = items[k % 5]
        words = item.split(" ")
        kind = k % 8
        if kind < 3:
            inside = edited(rng, item, 0.1 * kind)
        elif kind == 3:
            inside = " ".join(words[: len(words) // 2])
        elif kind == 4:
            inside = " ".join(words[len(words) // 3 :])
        elif kind == 5:
            inside = "which of the following is true about " + cases.prose(rng, 12)
        else:
            inside = " ".join(words[9:13])
        docs.append((k, cases.prose(rng, 25) + " " + inside + " " + cases.prose(rng, 25)))
    return docs, list(enumerate(items))


def tokens(text):
    return re.sub(r"[^0-9A-Za-z]+", " ", text).lower().split()


def all_pairs(docs, items):
    """Every pair of a document and an item, aligned plainly."""
    numbers, out = {}, {}
    for d, text in docs:
        for i, item in items:
            a, b = ([numbers.setdefault(w, len(numbers)) for w in tokens(t)] for t in (text, item))
            grams, own = {tuple(b[k : k + 3]) for k in range(len(b) - 2)}, {tuple(a[k : k + 3]) for k in range(len(a) - 2)}
            score = smith_waterman(a, b)
            if len(grams & own) >= max(1, int(0.15 * len(grams))) and score >= min(len(b), max(decontaminate.LEAST * len(b), decontaminate.LEAST_SCORE)):
                out[d, i] = score
    return out


def found_pairs(spark, docs, items):
    rows = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): r["score"] for r in rows}


def test_against_all_pairs(spark):
    docs, items = corpus(5)
    expected = all_pairs(docs, items)
    assert len(expected) > 40 and found_pairs(spark, docs, items) == expected


def test_many_seeds_meet_under_salts(spark, monkeypatch):
    docs, items = corpus(6)
    monkeypatch.setattr(decontaminate, "MOST_EXACT", 10)
    assert found_pairs(spark, docs, items) == all_pairs(docs, items)


def test_frequent_grams_are_no_seeds_and_any_passage_with_enough_grams_has_a_seed(spark):
    rng = random.Random(1)
    grams = [(item, 6, int(decontaminate.needed(20)), item * 100 + g if g > 2 else g) for item in range(4) for g in range(20)]
    held = [(p, 6, g) for p in range(300) for g in range(3)] + [(1000 + p, 6, item * 100 + g) for p in range(200) for item in [p % 4] for g in rng.sample(range(3, 20), 3)]
    seeds = decontaminate.rare_seeds(spark.createDataFrame(grams, "item long, class int, need int, gram long"), spark.createDataFrame(held, "passage long, class int, gram long")).collect()
    by_item = {i: {r["gram"] for r in seeds if r["item"] == i} for i in range(4)}
    assert all(len(s & {0, 1, 2}) <= 1 for s in by_item.values())
    of = {}
    for p, _, g in held:
        of.setdefault(p, set()).add(g)
    own = {i: {g for j, _, _, g in grams if j == i} for i in range(4)}
    assert all(of[p] & by_item[i] for p in of for i in range(4) if len(of[p] & own[i]) >= decontaminate.needed(20))


def test_stage_decides_by_row(spark, tmp_path):
    rng = random.Random(2)
    item, clean = cases.prose(rng, 40).replace("\n", " "), cases.prose(rng, 60)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, item), (None, clean), (7, clean), (8, item), (8, clean), (9, None), (None, None)]
    got = decontaminate.stage(spark, spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, gone_id string"), str(tmp_path))
    assert got.columns == ["doc_id", "text", "gone_id"]
    assert cases.rows_of(got.select("doc_id", "text")) == sorted([r for r in rows if r[1] != item], key=repr)
    assert decontaminate.stage(spark, cases.empty(spark), str(tmp_path)).collect() == []


def test_empty_tables(spark):
    items = spark.createDataFrame([], ITEMS)
    assert decontaminate.contaminated(cases.documents(spark), items).collect() == []
    assert decontaminate.contaminated(cases.empty(spark), items).collect() == []
