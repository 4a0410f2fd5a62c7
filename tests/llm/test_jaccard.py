import random
import time
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from agendario.llm import components, jaccard, shared

from . import cases


def brute(rows):
    sets = []
    for _, t in rows:
        w = cases.lowered(t)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                x, y = root[i], root[j]
                root = [y if r == x else r for r in root]
    least = defaultdict(list)
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r].append(d)
    return sorted([(d, len(s), min(least[r]) if least[r] and (s or d is None) else d) for (d, _), s, r in zip(rows, sets, root)], key=repr)


def test_against_brute_force_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 2000)
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 20)
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute(rows)
    assert cases.rows_of(jaccard.similar(docs)) == expected
    assert max(Counter(r[2] for r in expected).values()) > 8


def test_stage(spark):
    docs = cases.documents(spark)
    got = jaccard.stage(spark, docs, "")
    ids = Counter(r["doc_id"] for r in got.collect())
    roots = {r[2] for r in brute([(r["doc_id"], r["text"]) for r in docs.collect()])}
    assert got.columns == docs.columns and {i for i in ids if i is not None} == {r for r in roots if r is not None}
    assert ids[5] == 1 and ids[None] == 2


def test_stage_decides_by_row(spark):
    rng = random.Random(5)
    a, b = cases.prose(rng, 40), cases.prose(rng, 40)

    def kept(*rows):
        docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row_digest string")
        got = jaccard.stage(spark, docs, "")
        assert got.columns == docs.columns
        return sorted([tuple(r)[:2] for r in got.collect()], key=repr)

    assert kept((1, b), (5, a), (5, b), (9, a)) == [(1, b), (5, a)]
    assert kept((None, a), (7, a), (8, b), (8, a)) == sorted([(7, a), (8, b)], key=repr)
    assert kept((3, a), (3, a), (3, a), (4, ""), (4, ""), (None, None)) == sorted([(3, a), (4, ""), (4, ""), (None, None)], key=repr)
    assert kept((None, a), (None, a), (None, b)) == sorted([(None, a), (None, b)], key=repr)


def test_sets_that_share_all_but_their_own_words(spark):
    """One class of 5,000 sets in one pool, none of which links: linear, since only one set of the class goes on."""
    rng = random.Random(1)
    menu = cases.prose(rng, 120).replace("\n", " ")
    rows = [(k, menu + " " + " ".join(f"own{k}x{i}" for i in range(25))) for k in range(5000)]
    rows += [(6000 + k, menu + " " + " ".join(f"few{k}x{i}" for i in range(5))) for k in range(300)]
    sets = jaccard.stored(jaccard.described(spark.createDataFrame(rows, "doc_id long, text string")), "sets")
    assert jaccard.candidates(spark.createDataFrame(rows, "doc_id long, text string"), sets).count() == 5300
    began = time.perf_counter()
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[k] == k for k in range(5000)) and all(got[6000 + k] == 6000 for k in range(300))
    assert time.perf_counter() - began < 60


def test_hot_keys_are_met_by_broadcast_with_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(shared, "MOST_HUBS", 10)
    monkeypatch.setattr(components, "met", lambda rows, keyed, key, total: shared.met(rows, keyed, key, total, least=2))
    monkeypatch.setattr(jaccard, "met", lambda rows, keyed, key, total: shared.met(rows, keyed, key, total, least=2))
    docs = cases.documents(spark)
    assert cases.rows_of(jaccard.similar(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_table(spark):
    assert jaccard.stage(spark, cases.empty(spark), "").collect() == []


def test_bytes_of_a_shingle_whatever_the_number_of_blocks(spark):
    rng = random.Random(3)
    docs = spark.createDataFrame([(k, cases.prose(rng, 120)) for k in range(400)], "doc_id long, text string").coalesce(1)

    def a_shingle(blocks):
        rows = jaccard._dealt(docs, blocks, 1).collect()
        n = sum(len(r["tokens"]) for r in rows) / 7
        return sum(len(pa.compress(r[c], "lz4", asbytes=True)) if r[c] else 0 for r in rows for c in ("places", "counts", "tokens", "keys")) / n

    few, many = a_shingle(1), a_shingle(200)
    assert few < 7.5 and many < few + 2


def test_copies_in_other_groups_are_no_other_sets(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 7)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(jaccard, "BLOCK_KEYS", 2)
    rng = random.Random(4)
    alone, a = cases.prose(rng, 150), cases.prose(rng, 150)
    near = a + " ending otherwise"
    docs = spark.createDataFrame([(k, (alone, a, near)[k % 3]) for k in range(90)] + [(100, cases.prose(rng, 150))], "doc_id long, text string").repartition(3)
    sets = jaccard.stored(jaccard.described(docs), "sets")
    assert sorted(r["n"] for r in jaccard.candidates(docs, sets).collect()) == sorted(len({tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for w in (cases.lowered(a), cases.lowered(near)))
    assert cases.rows_of(jaccard.similar(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_stage_shuffles_documents_once(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(6)
        a, b = cases.prose(rng, 40), cases.prose(rng, 40)
        got = jaccard.stage(spark, spark.createDataFrame([(1, a), (1, a), (2, a), (3, b)], "doc_id long, text string"), "")
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
        assert sorted(got.collect()) == [(1, a), (3, b)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def shuffled(spark, frame):
    """Bytes that writing ``frame`` shuffles."""

    def so_far():
        found = spark._jsc.sc().statusStore().executorList(False)
        return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))

    before = so_far()
    frame.write.format("noop").mode("overwrite").save()
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    return so_far() - before


def test_stage_leaves_undecided_documents_where_they_are(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(8)
        rows = [(k, " ".join(f"{rng.getrandbits(64):x}" for _ in range(60))) for k in range(400)]
        docs = spark.createDataFrame(rows + [(400 + k, rows[k][1]) for k in range(9)] + [rows[0], (None, rows[1][1])], "doc_id long, text string")
        got = jaccard.stage(spark, docs, "")
        assert shuffled(spark, got) < sum(len(t) for _, t in rows) // 10
        assert sorted(got.collect()) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_filter_of_few_words_loses_no_decision(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_WORDS", jaccard.SLICE_WORDS)
    rng = random.Random(9)
    rows = [(k, f"{rng.getrandbits(64):x}") for k in range(60_000)]
    docs = spark.createDataFrame(rows, "row_id long, text string").withColumn("row_digest", jaccard._digest(F.col("text")))
    for held, least in ((docs, 60_000), (docs.where("row_id < 100"), 100), (docs.where("row_id < 0"), 0)):
        may = jaccard._bit_set(F.col("bits"), F.xxhash64("row_id", "row_digest"))
        found = {r["row_id"] for r in docs.join(jaccard._bits_of(held, "bits"), may, "left_semi").select("row_id").collect()}
        assert set(range(least)) <= found and (len(found) < least + 20 or least == 60_000)
