import numpy as np
import pytest

from agendario.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, cell long, v string, entry int, query_id long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 1, "v", 2, 3) for i, v in rows], schema)


def brute(rows, k=20, every=20):
    """(query id, [(score, id)]) of each query row, by all inner products."""
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    out = []
    for n in np.flatnonzero(ids % every == 0):
        score = (x * x[n]).sum(axis=1)
        order = [m for m in np.lexsort((ids, -score)) if m != n][:k]
        out.append((int(ids[n]), [(score[m], int(ids[m])) for m in order]))
    return out


def checked(got, rows, k=20):
    """Recall; every list is full, in order, and has true scores."""
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r.rank] = (r.score, r.vec_id)
    hits = total = 0
    known = {i: np.array(v, np.float64) for i, v in rows}
    for q, want in brute(rows, k):
        mine = [by[q][n] for n in range(1, len(want) + 1)] if want else []
        assert len(by.get(q, {})) == len(want)
        assert mine == sorted(mine, key=lambda p: (-p[0], p[1])) and q not in [i for _, i in mine]
        assert all(abs(s - (known[i] * known[q]).sum()) < 1e-12 for s, i in mine)
        hits, total = hits + len({i for _, i in mine} & {i for _, i in want}), total + len(want)
    return hits / max(total, 1)


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, d))
    x = rng.normal(size=(n, d)) * rng.uniform(0.5, 1.5, size=(n, 1))
    x[: n // 2] = centres[rng.integers(0, 9, n // 2)] + 0.3 * x[: n // 2]
    return x.astype(np.float32)


@pytest.mark.parametrize("small", [False, True])
def test_recall_of_query(spark, tmp_path, monkeypatch, small):
    """Norms differ, so that inner product and distance differ; small cells make grids of parts."""
    if small:
        monkeypatch.setattr(neighbours, "CELL_ROWS", 100)
        monkeypatch.setattr(neighbours, "CELL_QUERIES", 7)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(5, 3000, 24))]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = neighbours.op11_nearest_neighbours(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "double"]
    assert checked(got.collect(), rows) >= 0.9


def test_exact_where_all_is_asked(spark):
    """A sample of all queries and full recall: equal to brute force, ties and copies included."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(700)]
    rows = [(i, v) for i, v in rows if any(v)] + [(2000 + i, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(150)]
    found = neighbours.nearest(frame(spark, rows), recall=1.0, sample=10_000).collect()
    assert {r.query_id: [(-f.neg, f.id) for f in r.found] for r in found} == dict(brute(rows))


def test_odd_rows(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(20, same), (20, same), (40, [1.0, 0.0, 0.0]), (7, [0.0, 2.0, 0.0]), (20, [0.0, 0.0, -1.0])]
    odd = [(None, same), (60, None), (80, []), (100, [0.0, 0.0, 0.0]), (120, [None, 1.0, 1.0]), (140, [float("nan"), 1.0, 1.0]), (160, [float("inf"), 1.0, 1.0]), (180, [1.0, 2.0])]
    found = neighbours.nearest(frame(spark, rows + odd)).collect()
    got = sorted((r.query_id, [(-f.neg, f.id) for f in r.found]) for r in found)
    assert got == sorted(brute(rows)) and len(got) == 4
    doubles = spark.createDataFrame([(20, [0.1, 0.2]), (1, [0.3, 0.1]), (2, [-0.3, 0.1])], "id long, w array<double>")
    assert [(r.query_id, [f.id for f in r.found]) for r in neighbours.nearest(doubles, "id", "w").collect()] == [(20, [1, 2])]
    assert [r.found for r in neighbours.nearest(frame(spark, [(20, same)])).collect()] == [[]]
    assert neighbours.nearest(frame(spark, [])).collect() == []


def test_cells_and_scores():
    place = np.array([[0.2, 5.9], [-3.4, 2.5]])
    row, cells = neighbours.cells_within(place, 2, 0.8)
    want = [(n, (a, b)) for n, p in enumerate(place) for a in range(-9, 9) for b in range(-9, 12) if neighbours.edges(p, np.array([a, b])).sum() <= 0.8]
    assert sorted(zip(row.tolist(), map(tuple, cells.tolist()))) == want
