import numpy as np
import pytest
from pyspark.sql import types as T

from agendario.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, whitened int, explained string, x binary, n int"


def frame(spark, rows, kind=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "e", b"x", 2) for i, v in rows], kind)


def brute(vectors, k=16):
    """By numpy over all rows at once: the fit list, exact deviations, a dense eigensolver."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors]
    fit = sorted({tuple(r) for r in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    xc = np.array([[n * c - s for c, s in zip(r, sums)] for r in fit]) / n
    values, turn = np.linalg.eigh(xc.T @ xc / n)
    values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
    y = np.array([[n * c - s for c, s in zip(r, sums)] for r in x]) / n @ turn / np.sqrt(values)
    return n, [sum((n * c - s) ** 2 for c, s in zip(r, sums)) for r in x], y, values / (xc**2).sum() * n


def clouds(rng, n, d):
    x = rng.normal(size=(n, d)) * np.linspace(2, 0.3, d)
    x[: n // 3] += 3 * rng.normal(size=d)
    return x.astype(np.float32)


@pytest.mark.parametrize("n, d", [(400, 64), (60, 5), (300, 120)])
def test_query_against_dense_solver(spark, tmp_path, n, d):
    x = clouds(np.random.default_rng(d), n, d)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[4][1])] + [(9000 + i, rows[0][1]) for i in range(n // 3)]
    odd = [(1, None), (2, [None] + rows[0][1][1:]), (3, [float("nan")] + rows[0][1][1:]), (4, [float("-inf")] + rows[0][1][1:]), (5, []), (6, [1.0] * (d + 1))]
    frame(spark, rows + odd).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = whitening.op13_embedding_whitening(spark, str(tmp_path))
    assert [(f.name, f.dataType) for f in got.schema] == [("vec_id", T.LongType()), ("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    count, far, y, share = brute([v for _, v in rows])
    k = min(16, d)
    found = got.collect()
    assert len(found) == k * len(rows)
    assert {(r.n, r.identity_error < 1e-9) for r in found} == {(count, True)}
    by = {}
    for r in found:
        by.setdefault((repr(r.vec_id), r.deviation), {}).setdefault(r.component, []).append((r.whitened, r.explained))
    signs = np.zeros(k)
    for (i, _), f, row in zip(rows, far, y):
        mine = by[repr(i), f]
        for c in range(k):
            assert len({w for w, _ in mine[c + 1]}) == 1
            value, explained = mine[c + 1][0]
            assert abs(abs(value) - abs(row[c])) < 1e-7 and abs(explained / share[c] - 1) < 1e-9
            if abs(row[c]) > 1e-3:
                signs[c] = signs[c] or np.sign(value * row[c])
                assert signs[c] == np.sign(value * row[c])


def test_many_dimensions_need_rounds():
    """A flat spectrum in which the basis doesn't fill the space: residuals still come down."""
    rng = np.random.default_rng(1)
    q, _ = np.linalg.qr(rng.normal(size=(300, 300)))
    values = np.concatenate([np.linspace(10, 9, 20), np.linspace(8.9, 0, 280)])
    matrix, calls = (q * values) @ q.T, []
    found, vectors, far = whitening.lobpcg(lambda w: calls.append(w.shape[1]) or matrix @ w, 300, 16)
    assert np.abs(found - values[:16]).max() < 1e-10 and far.max() < 1e-11
    assert np.abs(np.abs((q[:, :16] * vectors).sum(0)) - 1).max() < 1e-9
    assert max(calls) <= 72 and len(calls) > 5


def test_pack_is_canonical():
    rng = np.random.default_rng(3)
    x = rng.integers(-5, 5, size=(50, 4)) * np.array([1, 100, 10**6, 10**12])[rng.integers(0, 4, 50)][:, None]
    x[0] = [127, -127, 0, 1]
    assert (whitening.unpack(whitening.pack(x), 4) == x).all()
    assert [len(r) for r in whitening.pack(np.array([[127], [128], [-32768], [2**31]]))] == [2, 3, 5, 9]


def test_deviations_stay_exact():
    x = np.array([[3, -(2**40)], [0, 5]])
    assert whitening.deviations(x, 10**9, [7, -9]) == [(3 * 10**9 - 7) ** 2 + (-(2**40) * 10**9 + 9) ** 2, 49 + (5 * 10**9 + 9) ** 2]


def test_no_direction_and_empty(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0]), (3, [1e30, 2.0]), (4, [])]).withColumnRenamed("embedding", "v"), vector="v", components=1).collect()
    assert len(one) == 3 and {len(r.whitened) for r in one} == {1} and one[0].identity_error < 1e-9
