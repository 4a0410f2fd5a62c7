"""Embedding whitening: principal components by LOBPCG over a distributed covariance, then rows scaled to unit variance.

Components become whole numbers, x = floor(scale * c) + shift, which makes sums and distances exact. The covariance is that of
each distinct x vector once (the *fit list*), and it is never formed: one Spark pass over the fit list multiplies it with a block
W, as the sum of xc (xc W) over the centred rows, task by task; the tasks' sums are added in two steps.

LOBPCG (locally optimal block preconditioned conjugate gradients): each round multiplies the orthonormal basis of
the iterate X, its residuals R and the previous directions P, solves the small projected problem (Rayleigh-Ritz)
and takes the leading vectors as the next X. The block has ``GUARD`` vectors more than are asked for, so that close eigenvalues
at its end don't slow it down. The whole basis is multiplied, not only R, so that residuals are those of
the covariance itself and no error gathers. Rounds end when each asked component's residual is at most ``TOLERANCE`` of the
largest eigenvalue, which bounds its eigenvalue's error by as much; if they stop falling above ``CERTIFIED``, the operator fails.

What the driver holds is a few blocks of (dimension x block size), whatever the number of rows.

Defined cases: null vectors and vectors with a null or non-finite component are left out, and so are those whose length
isn't that of most (ties: the longest); repeated rows and ids are each returned; null ids stay. Components whose eigenvalue is
under ``RANK`` of the trace have no direction of their own and are left out: no rows come back where all
vectors are equal, or the table is empty. Other columns are ignored. ``floor(scale * c)`` beyond 2**40 is taken as 2**40, both ways.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import stored, table
from .vectors import as_doubles, finite, of_one_length

COMPONENTS = 16
GUARD = 8
TOLERANCE = 1e-14
CERTIFIED = 1e-11
MOST_ROUNDS = 2000
#: Rounds without a smaller residual after which rounding is taken to be reached.
PATIENCE = 4
RANK = 1e-13

_LIMIT = 1 << 40
#: The tasks' sums meet in so many groups before the driver adds these.
_MEET = 16


def pack(x: np.ndarray) -> list[bytes]:
    """Each row of whole numbers in the narrowest of four widths that holds it, after a byte that names the width."""
    most = np.abs(x).max(axis=1, initial=0)
    out: list = [b""] * len(x)
    for width, upto, above in ((1, 127, -1), (2, 32767, 127), (4, 2**31 - 1, 32767), (8, 2**63 - 1, 2**31 - 1)):
        at = np.flatnonzero((most > above) & (most <= upto))
        raw = x[at].astype(f"<i{width}")
        for i, row in zip(at, raw):
            out[i] = bytes([width]) + row.tobytes()
    return out


def unpack(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(rows), dim), np.int64)
    widths = np.array([r[0] for r in rows], np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        out[at] = np.frombuffer(b"".join([rows[i][1:] for i in at]), f"<i{width}").reshape(len(at), dim)
    return out


def whole(vectors: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * c), the shift left out (it is the same for all and changes no difference)."""
    return np.clip(np.floor(scale * as_doubles(vectors, dim)), -_LIMIT, _LIMIT).astype(np.int64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """The sum over dimensions of (n x - S)**2, exactly."""
    most = max([abs(int(s)) for s in sums], default=0) + n * int(np.abs(x).max(initial=0))
    if len(sums) * most * most < 2**63:
        far = n * x - np.array(sums, np.int64)
        return (far * far).sum(axis=1).tolist()
    far = n * x.astype(object) - np.array(sums, object)
    return (far * far).sum(axis=1).tolist()


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    if n * _LIMIT < 2**62 or n * int(np.abs(x).max(initial=0)) < 2**62:
        return (n * x - np.array(sums, np.int64)) / n
    return x - np.array([s / n for s in sums])


def _summed(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The sum of matrices, one per task: first in ``_MEET`` groups, then on the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape), False
        for batch in batches:
            for m in batch.column(0).to_pylist():
                total, some = total + np.frombuffer(m).reshape(shape), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    met = rows.repartition(_MEET, F.spark_partition_id()).mapInArrow(add, "m binary").collect()
    return sum((np.frombuffer(r["m"]).reshape(shape) for r in met), np.zeros(shape))


def _over(fit: DataFrame, dim: int, shape: tuple[int, int], work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``work`` over blocks of the fit list's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                total += work(unpack(batch.column(0).slice(at, 2048).to_pylist(), dim))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    return _summed(fit.mapInArrow(run, "m binary"), shape)


def _orthonormal(first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """An orthonormal basis: of ``first``, then of what ``rest`` has beside it."""
    basis, _ = np.linalg.qr(first)
    if not rest.shape[1]:
        return basis
    size = np.linalg.norm(rest, axis=0)
    rest = rest[:, size > 0] / size[size > 0]
    for least in (1e-8, 0.5):
        rest = rest - basis @ (basis.T @ rest)
        rest = rest - basis @ (basis.T @ rest)
        u, s, _ = np.linalg.svd(rest, full_matrices=False)
        rest = u[:, s > least * max(1.0 if least > 0.1 else s.max(initial=0.0), 1e-300)][:, : basis.shape[0] - basis.shape[1]]
    return np.concatenate([basis, rest], axis=1)


def lobpcg(product: Callable[[np.ndarray], np.ndarray], dim: int, k: int, guard: int = GUARD, tolerance: float = TOLERANCE, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, their unit eigenvectors as columns, and residuals.

    ``product`` multiplies the matrix with a block of columns. Residuals are relative to the largest eigenvalue.
    """
    b = min(dim, k + guard)
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(dim, b)), np.zeros((dim, 0)))
    best, waited = (np.inf, None, None, None), 0
    for _ in range(MOST_ROUNDS):
        image = product(basis)
        small = basis.T @ image
        values, y = np.linalg.eigh((small + small.T) / 2)
        values, y = values[::-1][:b], y[:, ::-1][:, :b]
        x = basis @ y
        residual = image @ y - x * values
        if values[0] <= 0:
            return np.zeros(0), np.zeros((dim, 0)), np.zeros(0)
        far = np.linalg.norm(residual, axis=0) / values[0]
        worst = far[:k].max()
        waited = 0 if worst < 0.5 * best[0] else waited + 1
        if worst < best[0]:
            best = (worst, values[:k], x[:, :k], far[:k])
        if worst <= tolerance or best[0] <= CERTIFIED and waited >= PATIENCE:
            return best[1:]
        directions = basis[:, b:] @ y[b:] if basis.shape[1] > b else np.zeros((dim, 0))
        basis = _orthonormal(x, np.concatenate([residual[:, far > tolerance / 10], directions], axis=1))
    if best[0] <= CERTIFIED:
        return best[1:]
    raise RuntimeError(f"components did not settle: a residual is {best[0]:.2g} of the largest eigenvalue")


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = 64) -> DataFrame:
    """(``key``, n, deviation, whitened, explained, identity_error): every row's whitened components, the leading first.

    ``whitened`` and ``explained`` are arrays; ``deviation`` is a decimal, as it grows with the square of n; ``identity_error``
    is the largest entry of the whitened fit list's covariance minus the identity, measured by a pass of its own.
    """
    spark = rows.sparkSession
    taken, dim = of_one_length(rows.select(key, vector).where(finite(vector)), vector)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, deviation decimal(38,0), whitened array<double>"
    end = [F.lit(0).cast("long").alias("n"), "deviation", "whitened", F.array().cast("array<double>").alias("explained"), F.lit(None).cast("double").alias("identity_error")]
    if not dim:
        return spark.createDataFrame([], schema).select(key, *end)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(pack(whole(batch.column(0), dim, scale)), pa.binary())], ["x"])

    fit = stored(taken.select(vector).mapInArrow(packed, "x binary").distinct(), "whitening-fit")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for batch in batches:
            n += batch.num_rows
            for at in range(0, batch.num_rows, 4096):
                total = total + unpack(batch.column(0).slice(at, 4096).to_pylist(), dim).sum(axis=0).astype(object)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array([n, *map(int, total)], pa.decimal128(38, 0))], ["d", "s"])

    met = {r["d"]: int(r["s"]) for r in fit.mapInArrow(add, "d int, s decimal(38,0)").groupBy("d").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    n, sums = met[-1], [met[i] for i in range(dim)]

    def product(block: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray) -> np.ndarray:
            xc = _centred(x, n, sums)
            return xc.T @ (xc @ block)

        return _over(fit, dim, block.shape, work) / n

    values, vectors, _ = lobpcg(product, dim, min(components, dim))
    trace = _over(fit, dim, (1, 1), lambda x: (_centred(x, n, sums) ** 2).sum().reshape(1, 1))[0, 0] / n
    held = values > RANK * trace
    k = int(held.sum())
    if not k:
        return spark.createDataFrame([], schema).select(key, *end)
    turn, explained = vectors[:, held] / np.sqrt(values[held]), (values[held] / trace).tolist()

    def moments(x: np.ndarray) -> np.ndarray:
        y = _centred(x, n, sums) @ turn
        return np.concatenate([y.T @ y, y.sum(axis=0, keepdims=True)])

    seen = _over(fit, dim, (k + 1, k), moments) / n
    error = float(np.abs(seen[:k] - np.outer(seen[k], seen[k]) - np.eye(k)).max())

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x = whole(part.column(1), dim, scale)
                y = _centred(x, n, sums) @ turn
                lists = pa.ListArray.from_arrays(np.arange(0, y.size + 1, k, dtype=np.int32), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(deviations(x, n, sums), pa.decimal128(38, 0)), lists], [key, "deviation", "whitened"])

    out = taken.mapInArrow(scaled, schema)
    return out.select(key, F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.array(*map(F.lit, explained)).alias("explained"), F.lit(error).alias("identity_error"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vector and component. ``deviation`` is null where it doesn't fit in a long."""
    found = whiten(table(spark, sf_dir, "embeddings"))
    each = found.select("vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"), "explained", "identity_error")
    return each.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("at")).alias("explained"), "identity_error")
