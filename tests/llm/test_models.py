import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from agendario.llm import attention, lm_score, pu_quality

from . import cases

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def junk(rng, k):
    w = cases.prose(rng, 60).split()
    return [" ".join(x + rng.choice(["***", "%%%", "$$"]) for x in w), " ".join(x.upper() + "!!" for x in w), " ".join(x for x in w[:6] for _ in range(12))][k % 3]


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(1)
    texts = {5000 + k: (junk(rng, k), 0) if k % 7 == 0 else (cases.prose(rng, rng.randint(15, 120)), 1) for k in range(700)}
    docs = cases.documents(spark, [(d, t, "en", "q") for d, (t, _) in texts.items()])
    labels = spark.createDataFrame([(d, q, "x") for d, (_, q) in texts.items()] + [(None, 1, "x"), (5001, None, "x"), (3, 1, "x"), (3, 0, "x")], "doc_id long, quality int, text string")
    rows = pu_quality.stored(pu_quality.described(docs), "statistics")
    got = pu_quality.scored(rows, pu_quality.fit(rows, labels)).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in texts]
    assert len(held) > 80 and all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert np.mean([r["predicted"] == texts[r["doc_id"]][1] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)


def test_prior_and_scores_without_any_label_0(spark):
    """The prior comes from positives and unlabelled rows; equal texts get equal scores; the positives' bound moves little."""
    rng = random.Random(3)
    for share in (0.85, 0.5):
        texts = {k: (cases.prose(rng, rng.randint(15, 120)), 1) if rng.random() < share else (junk(rng, k), 0) for k in range(1500)}
        texts[1500] = texts[1501] = texts[0]
        rows = pu_quality.stored(pu_quality.described(spark.createDataFrame([(d, t) for d, (t, _) in texts.items()], "doc_id long, text string")), "statistics")
        labels = spark.createDataFrame([(d, q) for d, (_, q) in texts.items() if q == 1 and d % 3], "doc_id long, quality int")
        true = np.mean([q for _, q in texts.values()])
        for most in (10_000, 150):
            model = pu_quality.fit(rows, labels, max_positives=most)
            assert abs(model.prior - true) < (0.05 if most > 150 else 0.1)
            got = {r["doc_id"]: r for r in pu_quality.scored(rows, model).collect()}
            assert np.mean([got[d]["predicted"] == q for d, (_, q) in texts.items() if got[d]["held_out"]]) > 0.95
            assert got[0]["score"] == got[1500]["score"] == got[1501]["score"]


def test_features_of_awkward_texts():
    x = pu_quality.features(pa.array(["", None, " \n", *cases.texts()], pa.string()))
    assert x.shape == (len(cases.texts()) + 3, pu_quality.N_FEATURES) and np.isfinite(x).all() and not x[:3].any()


def test_without_labels_the_score_is_the_prior(spark):
    rows, nothing = pu_quality.described(cases.documents(spark)), pu_quality.described(cases.empty(spark))
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in pu_quality.scored(rows, pu_quality.fit(rows, none)).collect()} == {0.5}
    assert pu_quality.scored(nothing, pu_quality.fit(nothing, none)).collect() == []


def test_gradient():
    rng = np.random.default_rng(0)
    model = attention.Model(attention.initial(200), np.ones(200))
    model.w = {k: x.astype(float) for k, x in model.w.items()}
    model.tables()
    inputs, first, targets, _ = attention.windows(rng.integers(0, 199, 150), np.array([70, 0, 50, 30]), 199)
    loss, gradient = model.gradient(inputs, first, targets)
    for name, x in model.w.items():
        at = {"E": (int(inputs[0, -1]), 3), "G3": (int(targets[0, 3]) // 37, 2), "G2": (0, 2)}.get(name, tuple(int(rng.integers(0, s)) for s in x.shape))
        step, found = 1e-4, []
        for sign in (1, -1):
            x[at] += sign * step
            model.tables()
            found.append(model.gradient(inputs, first, targets)[0])
            x[at] -= sign * step
        model.tables()
        assert (found[0] - found[1]) / (2 * step) == pytest.approx(gradient[name][at], rel=2e-2, abs=1e-6), name


def test_windows_score_each_token_once_and_chances_add_up():
    lengths = np.array([1, 31, 32, 33, 200])
    inputs, first, targets, owner = attention.windows(np.arange(lengths.sum()), lengths, 999)
    assert sorted(targets[targets >= 0].tolist()) == list(range(lengths.sum()))
    model = attention.Model(attention.initial(37**3), np.ones(37**3))
    part = inputs[:1], first[:1]
    chances = [np.exp(model.log_chances(*part, np.where(np.arange(32) == 0, t, -1)[None, :])[0, 0]) for t in range(0, 37**3, 997)]
    assert 0 < sum(chances) < 1
    z = model.hidden(*part)[-1][:1]
    first_digit = np.exp(z @ model.w["U1"] + model.b1)
    assert first_digit.shape == (1, 37)


def test_a_token_32_back_changes_the_chance():
    ids, far = np.arange(96) % 50, np.arange(96) % 50
    far[64 - 32] = 49
    model = attention.Model(attention.initial(51), np.ones(51))

    def chances(x):
        inputs, first, targets, _ = attention.windows(x, np.array([96]), 50)
        return model.log_chances(inputs, first, targets).ravel()

    changed = np.flatnonzero(chances(ids) != chances(far))
    assert changed[0] == 32 and 64 in changed


def test_training_lowers_the_loss():
    ids = np.concatenate([np.tile([5, 9, 7, 3], 50) for _ in range(20)])
    lengths = np.full(20, 200)
    model = attention.Model(attention.initial(50), np.bincount(ids, minlength=50))
    before = model.score(ids, lengths, 49).sum()
    model.train(ids, lengths, 49, 0.02, epochs=60)
    assert model.score(ids, lengths, 49).sum() > 0.5 * before


def test_training_takes_every_learnable_document(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "WARM_DOCUMENTS", 1)
    ranks = spark.sparkContext.broadcast(lm_score.read_ranks(RANKS))
    end = max(ranks.value.values()) + 1
    groups = lm_score.grouped(cases.documents(spark), "every", ranks, public_tokenizers.PATTERN, end).cache()
    expected = set()
    for row in groups.collect():
        lengths = np.frombuffer(row["sizes"], "<u4")
        expected |= set(np.frombuffer(row["ids"], "<u2")[np.repeat(np.array(row["learned"]), lengths)].tolist())
    model = lm_score.trained(groups, end + 1, end)
    changed = np.flatnonzero((model.w["E"] != attention.initial(end + 1)["E"]).any(axis=1))
    assert set(changed.tolist()) == expected and len(expected) > 100


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 700)
    monkeypatch.setattr(lm_score, "GROUP_ROWS", 30)
    docs = cases.documents(spark)
    rows = [(r["doc_id"], [*cases.lowered(r["text"]), "\n"]) for r in docs.collect()]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    counts = Counter(w for (_, ws), h in zip(rows, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted([(d, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for (d, ws), h in zip(rows, held)], key=repr)
    got = lm_score.scores(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted([(*r[:5], round(r[5], 6)) for r in got], key=repr) == expected
    assert all(r["score"] < 0 for r in got)


def test_lm_scores_of_nothing(spark):
    assert lm_score.scores(cases.empty(spark), RANKS, public_tokenizers.PATTERN).collect() == []
