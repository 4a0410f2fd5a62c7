"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled ``quality`` 1; everything else the model sees is
unlabelled web text. A small network (one hidden layer) minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

in which R_p and R_u are the mean logistic losses over positives and unlabelled rows. Inputs are statistics of the
text alone. Rows whose crc32 of the id is divisible by 5 are held out: neither their labels nor
their texts are used.

The statistics of all texts are computed once and stored. Standardisation and fit cover every unlabelled row that
may be learned from: in each of ``ROUNDS`` rounds every task trains a copy of the network on its own rows, all of them,
beside the positives, and the copies are averaged, weighted by their rows. Only the trusted positives are
bounded: at most ``max_positives`` (a parameter of ``fit``), those with the smallest hashed ids.

The class prior comes from positives and unlabelled rows alone: a first network, fitted on half of both, tells the
two apart. On the other half, each region of highest scores has a ratio of its unlabelled to its positive
share, which is no less than the prior and near it where hardly a negative is left. The region with the least
ratio plus ``ERRORS`` standard errors decides, so that a few rows do not.

Defined cases: null or empty text has all statistics 0 and gets the model's score of that; an id
with contradicting labels is no trusted positive; null labels are ignored; a null id is never
held out and never learned from; with fewer than two trusted positives every score is 0.5; rows of equal statistics get equal
scores; repeated rows are each returned; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, table
from .wordhash import Words, pieces, text_buffers, window_hashes

MAX_POSITIVES = 10_000
FOLDS = 5
THRESHOLD = 0.3
HIDDEN = 12
ROUNDS = 3
#: Steps of a task and round at least, even where it has few rows.
LEAST_STEPS = 200
BATCH = 2048
ERRORS = 2
#: The region that decides on the prior holds at least this share of the positives.
LEAST_SHARE = 0.5
BINS = 2000

_CLASSES = {
    "symbol": b"#*$%&|<>@^~=+_{}[]\\/",
    "bar": b"|\t",
    "mark": b"!?",
    "digit": b"0123456789",
    "upper": bytes(range(65, 91)),
    "lower": bytes(range(97, 123)),
    "stop": b".,;:",
    "space": b" \t\n\x0b\x0c\r",
    "wide": bytes(range(0xC0, 0x100)),
}
_TABLES = {name: np.isin(np.arange(256), np.frombuffer(chars, np.uint8)) for name, chars in _CLASSES.items()}
N_FEATURES = 14


def _distinct_share(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per document: distinct entries over entries, and the share of the most frequent entry."""
    share, most = np.zeros(len(at) - 1), np.zeros(len(at) - 1)
    for i, (lo, hi) in enumerate(zip(at[:-1], at[1:])):
        if hi > lo:
            own = np.sort(hashes[lo:hi])
            cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1], True])
            share[i], most[i] = (len(cuts) - 1) / (hi - lo), np.diff(cuts).max() / (hi - lo)
    return share, most


def features(column: pa.Array) -> np.ndarray:
    """One row of statistics per text (null: empty)."""
    raw, offs = text_buffers(column)
    out = []
    for a, b in pieces(offs):
        words = Words(raw, offs[a : b + 1])
        own, at = words.offs, words.doc_at
        count = {}
        for name, mask in _TABLES.items():
            total = np.zeros(len(words.raw) + 1, np.int64)
            np.cumsum(mask[words.raw], out=total[1:])
            count[name] = total[own[1:]] - total[own[:-1]]
        size, n = np.maximum(np.diff(own), 1), np.diff(at)
        least = np.maximum(n, 1)
        letters = np.maximum(count["upper"] + count["lower"] + count["wide"], 1)
        same = np.zeros(len(words.hash) + 1, np.int64)
        if len(words.hash):
            again = np.r_[False, words.hash[1:] == words.hash[:-1]]
            again[at[:-1][at[:-1] < len(words.hash)]] = False
            np.cumsum(again, out=same[1:])
        distinct, most = _distinct_share(words.hash, at)
        triples = window_hashes(words.hash, 3)
        ends = np.minimum(np.maximum(at[1:] - 2, at[:-1]), len(triples))
        fresh = np.ones(len(n))
        for i in np.flatnonzero(ends > at[:-1]):
            own3 = np.sort(triples[at[i] : ends[i]])
            fresh[i] = (1 + np.count_nonzero(own3[1:] != own3[:-1])) / len(own3)
        out.append(np.stack([
            count["symbol"] / size, count["bar"] / least, count["mark"] / least, count["digit"] / size,
            count["upper"] / letters, count["stop"] / least, letters / size, np.log1p(n),
            (size - count["space"]) / least / 8, distinct, most, (same[at[1:]] - same[at[:-1]]) / least, fresh * (n > 0), (n > 0).astype(float),
        ], axis=1) * (n > 0)[:, None])
    return np.concatenate(out) if out else np.zeros((0, N_FEATURES))


class Model:
    """A network with one hidden layer on standardised features; without weights, one score for all."""

    def __init__(self, mean: np.ndarray | None = None, scale: np.ndarray | None = None, seed: int = 11):
        self.mean, self.scale, self.weights = mean, scale, None
        if mean is not None:
            rng = np.random.default_rng(seed)
            self.weights = [rng.normal(0, 0.4, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.4, HIDDEN), np.zeros(1)]

    def ready(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        w = self.weights
        return 1 / (1 + np.exp(-np.clip(np.tanh(self.ready(x) @ w[0] + w[1]) @ w[2] + w[3], -30, 30)))

    def train(self, p: np.ndarray, u: np.ndarray, prior: float, rate: float, seed: int) -> None:
        """Adam on the non-negative risk of positives and unlabelled rows (both ready); every row of ``u`` is used."""
        rng = np.random.default_rng(seed)
        w = [x.copy() for x in self.weights]
        first, second = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
        epochs = -(-LEAST_STEPS * BATCH // len(u))
        order = np.concatenate([rng.permutation(len(u)) for _ in range(epochs)])
        steps = -(-len(order) // BATCH)
        for step in range(1, steps + 1):
            ub = u[order[(step - 1) * BATCH : step * BATCH]]
            n, m = min(len(p), BATCH), len(ub)
            x = np.concatenate([p[rng.integers(0, len(p), n)], ub])
            hidden = np.tanh(x @ w[0] + w[1])
            g = hidden @ w[2] + w[3]
            chance = 1 / (1 + np.exp(-g))
            loss_minus = np.logaddexp(0, g)
            negative = loss_minus[n:].mean() - prior * loss_minus[:n].mean()
            d = np.zeros(len(x))
            d_minus = np.r_[-prior * chance[:n] / n, chance[n:] / m]
            if negative >= 0:
                d[:n] = -prior * (1 - chance[:n]) / n
                d += d_minus
            else:  # the risk of negatives can't be below 0: undo the step that made it so
                d -= d_minus
            back = np.outer(d, w[2]) * (1 - hidden**2)
            grads = [x.T @ back + 1e-4 * w[0], back.sum(0), hidden.T @ d + 1e-4 * w[2], d.sum(keepdims=True)]
            now = rate * (1 - step / (steps + 1))
            for k, grad in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.99 * second[k] + 0.01 * grad**2
                w[k] = w[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
        self.weights = w


def _fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


_X = [f"x{k}" for k in range(N_FEATURES)]


def described(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics x0, x1, ... of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in x.T]], ["doc_id", *_X])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, " + ", ".join(f"{x} float" for x in _X))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in _X], axis=1).astype(float)


def _round(rows: DataFrame, model: Model, positives: np.ndarray, prior: float, rate: float) -> None:
    """Every task trains a copy on its rows; the copies' mean is the model's new weights."""
    shared = rows.sparkSession.sparkContext.broadcast((model, model.ready(positives)))
    shapes = [x.shape for x in model.weights]

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy, p = shared.value
        parts = [copy.ready(_matrix(b)) for b in batches if b.num_rows]
        if parts:
            u = np.concatenate(parts)
            task = TaskContext.get().partitionId()
            own = Model(copy.mean, copy.scale)
            own.weights = copy.weights
            own.train(p, u, prior, rate, seed=task)
            flat = np.concatenate([x.ravel() for x in own.weights])
            yield pa.RecordBatch.from_arrays([pa.array([task % 64], pa.int32()), pa.array([float(len(u))]), pa.array([flat.tobytes()], pa.binary())], ["part", "n", "w"])

    def mean(out: pa.Table) -> pa.Table:
        n = out["n"].to_numpy()
        w = sum(k * np.frombuffer(x.as_py()) for k, x in zip(n, out["w"])) / n.sum()
        return pa.table({"part": out["part"].slice(0, 1), "n": pa.array([float(n.sum())]), "w": pa.array([w.tobytes()], pa.binary())})

    copies = rows.select(*_X).mapInArrow(train, "part int, n double, w binary").groupBy("part").applyInArrow(mean, "part int, n double, w binary").collect()
    if not copies:
        return
    total = sum(r["n"] for r in copies)
    flat, at = sum(r["n"] / total * np.frombuffer(r["w"]) for r in copies), 0
    for k, shape in enumerate(shapes):
        size = int(np.prod(shape))
        model.weights[k] = flat[at : at + size].reshape(shape)
        at += size


def estimated_prior(rows: DataFrame, model: Model, positives: np.ndarray) -> float:
    """The ratio of unlabelled to positive share in the region of highest scores where it is surely lowest."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def bins(scores: np.ndarray) -> np.ndarray:
        return np.minimum((scores * BINS).astype(int), BINS - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BINS, np.int64)
        for b in batches:
            total += np.bincount(bins(shared.value.score(_matrix(b))), minlength=BINS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bin", "n"])

    u, p = np.zeros(BINS), np.bincount(bins(model.score(positives)), minlength=BINS)
    # At most ``BINS`` rows.
    for r in rows.select(*_X).mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        u[r["bin"]] = r["n"]
    above_u, above_p = u[::-1].cumsum() / max(u.sum(), 1), p[::-1].cumsum() / p.sum()
    ok = above_p >= LEAST_SHARE
    above_u, above_p = above_u[ok], above_p[ok]
    ratio = above_u / above_p
    error = np.sqrt((1 - above_p) / above_p / p.sum() + (1 - above_u) / np.maximum(above_u, 1e-9) / max(u.sum(), 1))
    return float(np.clip(ratio[np.argmin(ratio * (1 + ERRORS * error))], 0.01, 0.99))


def fit(rows: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES, rounds: int = ROUNDS) -> Model:
    """The model from ``rows`` (of ``described``) and ``labels`` (doc_id, quality), held-out rows left out.

    ``max_positives`` bounds the trusted positives; the unlabelled rows have no bound.
    """
    open_ = rows.where(_fold(F.col("doc_id")) != 0)
    known = labels.where(F.col("quality").isNotNull() & (_fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    trusted = known.where(F.col("quality") == 1).select("doc_id")
    chosen = trusted.join(open_.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives)
    # At most ``max_positives`` ids: a proven bound for the broadcast and for what is collected.
    found = open_.join(F.broadcast(chosen), "doc_id", "left_semi").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    if len(found) < 2:
        return Model()
    positives = np.array([[r[x] for x in _X] for r in found], float)
    stats = open_.agg(*[F.avg(x) for x in _X], *[F.stddev_pop(x) for x in _X]).first()
    mean, scale = np.array(stats[:N_FEATURES]), np.array(stats[N_FEATURES:]) + 1e-3
    half, side = F.xxhash64("doc_id", F.lit(7)) % 2 == 0, np.arange(len(positives)) % 2 == 0
    first = Model(mean, scale)
    _round(open_.where(half), first, positives[side], 0.5, 0.01)
    prior = estimated_prior(open_.where(~half), first, positives[~side])
    model = Model(mean, scale)
    for k in range(rounds):
        _round(open_, model, positives, prior, 0.02 / (1 + k))
    model.prior = prior
    return model


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``described``."""
    weights = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(weights.value.score(_matrix(batch)), pa.float64())], ["doc_id", "score"])

    held = F.coalesce(_fold(F.col("doc_id")) == 0, F.lit(False))
    found = rows.mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(described(table(spark, sf_dir, "documents")), "statistics")
    return scored(rows, fit(rows, table(spark, sf_dir, "labels").select("doc_id", "quality")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of ``docs`` whose text the classifier takes for quality 1, with all their columns."""
    rows = stored(described(docs), "statistics")
    model = spark.sparkContext.broadcast(fit(rows, table(spark, sf_dir, "labels").select("doc_id", "quality")))

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.value.score(features(texts).astype(np.float32).astype(float)), pa.float64())

    return docs.where(score(F.col("text").cast("string")) >= THRESHOLD)
