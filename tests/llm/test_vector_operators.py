"""Whitening and curve search against plain numpy, on the given vectors and on awkward ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landfall.llm import curve_search, whitening

from .conftest import SF

NAN, INF = float("nan"), float("inf")
ODD_ROWS = [(1, None), (2, []), (3, [1.0, None, 2.0]), (4, [NAN, 1.0, 1.0]), (5, [INF, 1.0, 1.0]), (6, [1.0, 2.0]), (7, [0.0, 0.0, 0.0])]


def frame(spark, rows):
    """Rows with columns whose names clash with those that the operators make."""
    return spark.createDataFrame([(i, v, 3, 0.5, "r", 1) for i, v in rows], "vec_id long, embedding array<double>, point int, score double, rank string, n int")


def brute_whitened(vectors):
    x = np.floor(256 * vectors).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    v = centred.T @ centred / n
    value, vector = np.linalg.eigh(v)
    order = np.argsort(-value)[:4]
    white = (x - total / n) @ vector[:, order] / np.sqrt(value[order])
    return n, ((n * x - total) ** 2).sum(axis=1), white, value[order] / np.trace(v)


def test_whitening_equals_dense_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = rows.union(rows.limit(7))  # repeated rows have results of their own and count once in the fit
    own = [r for r in rows.collect() if r["embedding"]]
    n, deviation, white, explained = brute_whitened(np.array([r["embedding"] for r in own]))
    got = whitening.whiten(rows).collect()
    assert len(got) == 4 * len(own) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    expected = {(r["vec_id"], c + 1): (int(deviation[k]), white[k, c], explained[c]) for k, r in enumerate(own) for c in range(4)}
    for c in range(1, 5):
        mine = [r for r in got if r["component"] == c]
        a = np.array([r["whitened"] for r in mine])
        b = np.array([expected[r["vec_id"], c][1] for r in mine])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8  # one sign for all rows
        assert all(r["deviation"] == expected[r["vec_id"], c][0] and abs(r["explained"] - expected[r["vec_id"], c][2]) < 1e-12 for r in mine)


def test_whitening_of_odd_rows(spark):
    plane = [(10 + k, [float(k % 5), 2.0 * (k % 5), 7.0]) for k in range(20)]  # on a line: one component
    got = whitening.whiten(frame(spark, ODD_ROWS[:6] + plane + [(None, [0.5, 1.0, 7.0])])).collect()
    assert len(got) == 21 and {r["component"] for r in got} == {1} and {r["n"] for r in got} == {6}
    assert abs(sum(r["explained"] for r in got) / 21 - 1) < 1e-9 and max(r["identity_error"] for r in got) < 1e-9
    assert whitening.whiten(frame(spark, ODD_ROWS[:5])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # all alike
    assert whitening.whiten(frame(spark, [])).count() == 0
    far = [(k, [2.0 ** 40 * k, 1.0]) for k in range(5)]  # deviations beyond 64 bits
    assert {r["deviation"] for r in whitening.whiten(frame(spark, far)).collect()} == {None, 0}


@pytest.mark.parametrize("seed", range(3))
def test_feast_finds_every_eigenpair(seed):
    rng = np.random.RandomState(seed)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    for values in (rng.uniform(1, 2, 40), np.r_[5, 5, 5, 5, 5, np.ones(35)], np.r_[9, 9 - 1e-9, 1, np.zeros(37)], 2.0 ** -np.arange(40)):
        v = q @ np.diag(values) @ q.T
        v = (v + v.T) / 2
        value, vector = whitening.largest_eigenpairs(v)
        want = np.sort(values)[::-1][:4]
        want = want[want > 1e-10]
        assert np.allclose(value, want, rtol=1e-10) and np.abs(v @ vector - vector * value).max() < 1e-12 * values.max() * 40
        assert np.abs(vector.T @ vector - np.eye(value.size)).max() < 1e-13
        t = whitening.tridiagonal(v)
        assert whitening.inertia_above(t, 1.5) == (values > 1.5).sum()


def brute_nearest(rows, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    s = x @ x.T
    return {int(ids[q]): [(int(ids[j]), s[q, j]) for j in np.lexsort((ids, -np.round(s[q], 12))) if j != q][:k] for q in range(len(ids)) if ids[q] % 20 == 0}


def found(spark, rows, **more):
    out = {}
    for r in curve_search.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def check_nearest(got, want, least=0.9):
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= least
    for q in want:
        known = dict(want[q])
        assert all(abs(known[i] - s) < 1e-12 for i, s in got[q] if i in known)
        assert sorted(got[q], key=lambda x: (-x[1], x[0])) == got[q]


def test_nearest_of_the_given_vectors(spark):
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    check_nearest(found(spark, rows), brute_nearest(rows))


def test_nearest_with_clusters_copies_and_lengths(spark):
    """Vectors of different lengths in clusters, more rows than a window, and a third of the rows equal."""
    rng = np.random.RandomState(4)
    centres = rng.standard_normal((30, 12)) * 3
    x = centres[rng.randint(30, size=3000)] + 0.2 * rng.standard_normal((3000, 12))
    rows = [(int(k), v.tolist()) for k, v in enumerate(x)]
    check_nearest(found(spark, rows), brute_nearest(rows))
    same = [(5000 + k, rows[17][1]) for k in range(400)]
    got = found(spark, rows[:800] + same)
    want = brute_nearest(rows[:800] + same)
    check_nearest(got, want)
    assert all(got[q] == [(i, s) for i, s in got[q]] and [i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want if q >= 5000)


def test_nearest_of_odd_rows(spark):
    few = [(20, [1.0, 0.0, 0.0]), (21, [0.0, 2.0, 0.0]), (40, [-1.0, 0.0, 0.5]), (None, [1.0, 1.0, 1.0]), (21, [0.0, 2.0, 0.0])]
    got = found(spark, ODD_ROWS + few)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {20: [21, 40], 40: [21, 20]}
    assert found(spark, []) == {} and found(spark, few[:1]) == {} and found(spark, few[1:2]) == {}


def test_hilbert_neighbours_are_one_step_apart():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        key = curve_search.hilbert_keys(grid, bits)
        assert np.array_equal(np.sort(key), np.arange(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()
