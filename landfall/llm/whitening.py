"""Whitening of embeddings by FEAST contour integration.

Entries become whole numbers ``floor(256 * c)``. The covariance of the distinct vectors is summed up by
Spark in two passes (sums, then centred products); what reaches the driver is a matrix of dimensions by
dimensions, whatever the number of rows. Its largest eigenvalues are enclosed by inertia counts (Sturm
sequences of the tridiagonal form). For each interval a quadrature of complex shifted solves
``(z I - V) X = Y`` on a circle around it projects a block of vectors onto the interval's eigenspace,
Rayleigh-Ritz extracts eigenpairs from it, and both repeat until the residuals vanish. The number of
pairs found must be the difference of the inertia counts at the interval's ends, so none is missed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import Scratch

COMPONENTS = 4
SCALE = 256
NODES = 16
#: Eigenvalues below this share of the trace count as zero: there the rows don't vary.
LEAST = 1e-12
#: Eigenvalues nearer than this share of the largest lie in one interval.
APART = 1e-6
ROUNDS = 60


# ---- eigenpairs of a small symmetric matrix ----


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of ``v`` (Householder)."""
    a = v.astype(np.float64).copy()
    for k in range(a.shape[0] - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += math.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        a[k + 1:, :] -= 2 * np.outer(x, x @ a[k + 1:, :])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia_above(t: tuple[np.ndarray, np.ndarray], at: float) -> int:
    """How many eigenvalues lie above ``at``: positive pivots of the shifted tridiagonal matrix."""
    d, e = t
    tiny = np.finfo(float).tiny
    count, q = 0, 1.0
    for k in range(d.size):
        q = d[k] - at - (e[k - 1] ** 2 / q if k else 0.0)
        if abs(q) < tiny:
            q = -tiny
        count += q > 0
    return count


def enclosed(t: tuple[np.ndarray, np.ndarray], number: int) -> tuple[float, float]:
    """Bounds of the ``number``-th largest eigenvalue (from 1), bisected by inertia counts."""
    d, e = t
    reach = np.abs(np.append(e, 0)) + np.abs(np.append(0, e))
    lo, hi = float((d - reach).min()), float((d + reach).max())
    lo, hi = lo - 1e-12 * (abs(lo) + 1), hi + 1e-12 * (abs(hi) + 1)
    for _ in range(200):
        mid = (lo + hi) / 2
        if not lo < mid < hi:
            break
        lo, hi = (mid, hi) if inertia_above(t, mid) >= number else (lo, mid)
    return lo, hi


def feast(v: np.ndarray, a: float, b: float, inside: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``inside`` eigenpairs of the symmetric matrix ``v`` with values in (a, b)."""
    d = v.shape[0]
    centre, radius = (a + b) / 2, (b - a) / 2
    # Gauss-Legendre nodes on the upper half of the circle; the lower half is their conjugate.
    x, w = np.polynomial.legendre.leggauss(NODES)
    angle = math.pi / 2 * (x + 1)
    points = [(w[k] / 2 * radius * np.exp(1j * angle[k]), centre + radius * np.exp(1j * angle[k])) for k in range(NODES)]
    solve = [(c, np.linalg.inv(z * np.eye(d) - v)) for c, z in points]
    size = min(d, 2 * inside + 2)
    y = np.random.RandomState(7).standard_normal((d, size))
    scale = np.abs(v).max() * d
    while True:
        for _ in range(ROUNDS):
            q = sum((c * (s @ y)).real for c, s in solve)
            q, _ = np.linalg.qr(q / np.abs(q).max())
            value, part = np.linalg.eigh(q.T @ v @ q)
            y = q @ part
            own = (value > a) & (value < b)
            left = np.abs(v @ y[:, own] - y[:, own] * value[own]).max(initial=0)
            if own.sum() == inside and left <= 1e-14 * scale:
                return value[own], y[:, own]
        if own.sum() == inside and left <= 1e-11 * scale:
            return value[own], y[:, own]
        if size == d:
            raise ArithmeticError(f"{int(own.sum())} eigenpairs found of the {inside} that inertia counts between {a} and {b}")
        size = min(d, 2 * size)
        y = np.concatenate([y, np.random.RandomState(size).standard_normal((d, size - y.shape[1]))], axis=1)


def largest_eigenpairs(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues above zero (falling) and their unit vectors (columns); of a
    vector's two signs the one whose largest entry is positive."""
    trace = float(np.trace(v))
    if v.size == 0 or not trace > 0:
        return np.empty(0), np.empty((v.shape[0], 0))
    # A single eigenvalue beside an interval of no width has no room for a circle: values are scaled first.
    scaled = v / trace
    t = tridiagonal(scaled)
    most = min(most, inertia_above(t, LEAST))
    near = [sum(enclosed(t, k)) / 2 for k in range(1, min(most + 1, v.shape[0]) + 1)]
    while len(near) < v.shape[0] and near[-2:] and near[-1] > near[most - 1] - APART * near[0]:  # the last one's equals belong to its interval
        near.append(sum(enclosed(t, len(near) + 1)) / 2)
    values, vectors, upper, k = [], [], near[0] * (1 + 1e-3), 0
    while k < most:
        last = k
        while last + 1 < len(near) and near[last] - near[last + 1] <= APART * near[0]:
            last += 1
        lower = (near[last] + near[last + 1]) / 2 if last + 1 < len(near) else near[last] - max(near[last], APART) * 0.5
        count = inertia_above(t, lower) - inertia_above(t, upper)
        value, vector = feast(scaled, lower, upper, count)
        order = np.argsort(-value, kind="stable")
        values.append(value[order])
        vectors.append(vector[:, order])
        upper, k = lower, last + 1
    value, vector = np.concatenate(values)[:most], np.concatenate(vectors, axis=1)
    vector, _ = np.linalg.qr(vector)  # intervals are apart, so this only tidies the last digits
    vector = vector[:, :most]
    sign = np.sign(vector[np.abs(vector).argmax(axis=0), np.arange(vector.shape[1])])
    return value * trace, vector * sign


# ---- statistics of the rows ----


def _whole(column: pa.ListArray) -> np.ndarray:
    """The vectors of a column of equally long lists as whole numbers."""
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64).reshape(len(column), -1)


def _encoded(batches):
    """Whole vectors as bytes of the narrowest width that holds them."""
    for b in batches:
        x = _whole(b.column(0))
        out = []
        for row in np.unique(x, axis=0) if len(x) else x:
            top = int(np.abs(row).max(initial=0))
            width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
            out.append(bytes([width]) + row.astype(f"<i{width}").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["x"])


def _decoded(column) -> np.ndarray:
    return np.array([np.frombuffer(x, dtype=f"<i{x[0]}", offset=1) for x in column.to_pylist()], dtype=np.int64)


def _sums(batches):
    n, total = 0, None
    for b in batches:
        if b.num_rows:
            x = _decoded(b.column(0))
            part = [sum(c) for c in x.T.tolist()] if np.abs(x).max(initial=0) >= 1 << 40 else x.sum(axis=0).tolist()
            total = part if total is None else [p + q for p, q in zip(total, part)]
            n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([str(t) for t in total]), pa.array([n] * len(total), pa.int64())], ["i", "s", "n"])


def _centred_products(mean: np.ndarray, project: np.ndarray | None = None):
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                c = _decoded(b.column(0)) - mean
                c = c if project is None else c @ project
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "row"])

    return run


def _covariance(fit: DataFrame, n: int, size: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    parts = fit.mapInArrow(_centred_products(mean, project), "i int, row array<double>")
    out = np.zeros((size, size))
    for r in parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = r["v"] / n
    return (out + out.T) / 2


def usable(rows: DataFrame, most: int | None = None) -> DataFrame:
    """``rows`` without those whose vector is NULL or empty, holds a NULL or non-finite entry (with
    ``most``: or one beyond it), or has not the length of most others (the shorter of equally frequent ones)."""
    bound = F.lit(float("inf") if most is None else float(most))
    v = F.col("embedding")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < bound), F.lit(False)))
    rows = rows.filter(fine)
    length = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("embedding") == length["d"]) if length else rows.limit(0)


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _results(n: int, sums: list[int], value: np.ndarray, vector: np.ndarray, explained: np.ndarray, error: float):
    mean, project = np.array([s / n for s in sums]), vector / np.sqrt(value)
    k = value.size

    def deviations(x: np.ndarray) -> list[int | None]:
        far = float(np.abs(x).max(initial=0)) * n + max(map(abs, sums))
        if far * far * x.shape[1] < 2.0 ** 62:
            return ((n * x - np.array(sums, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        every = (sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist())
        return [e if e < 1 << 63 else None for e in every]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = _whole(b.column(1))
            white = (x - mean) @ project
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, n)),
                 pa.array([d for d in deviations(x) for _ in range(k)], pa.int64()), pa.array(white.reshape(-1)),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(rows: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """The first ``most`` whitened coordinates of every usable row of ``rows (vec_id, embedding, ...)``:
    ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Rows with a NULL vector, a NULL or non-finite entry, an entry whose whole number does not fit in 64
    bits, or another length than most, are dropped; rows that repeat, and NULL ids, are kept, each with
    rows of its own. Components whose eigenvalue is zero are left out, so vectors that are all alike, and
    an empty table, give no rows. ``deviation`` is NULL where it does not fit in 64 bits. Other columns
    are ignored."""
    spark = rows.sparkSession
    scratch = Scratch(spark)
    v = usable(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")), 2 ** 54)
    fit = scratch.written(v.select("embedding").mapInArrow(_encoded, "x binary").distinct(), "whitening-fit")
    sums = fit.mapInArrow(_sums, "i int, s string, n long").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).orderBy("i").collect()
    if not sums:
        return spark.createDataFrame([], _OUT)
    n, total = sums[0]["n"], [int(r["s"]) for r in sums]
    mean = np.array([s / n for s in total])
    cov = _covariance(fit, n, len(total), mean)
    value, vector = largest_eigenpairs(cov, most)
    if not value.size:
        return spark.createDataFrame([], _OUT)
    white = _covariance(fit, n, value.size, mean, vector / np.sqrt(value))
    error = float(np.abs(white - np.eye(value.size)).max())
    scratch.free(fit)
    return v.mapInArrow(_results(n, total, value, vector, value / float(np.trace(cov)), error), _OUT)
