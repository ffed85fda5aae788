"""Embedding whitening by the leading principal components.

Sums and the centred second moments are gathered on the cluster in exact integers, so the covariance does
not depend on partitions or retries. Its size is the square of the vectors' length, whatever the number of
rows; the driver brings it to tridiagonal form by Householder reflections, finds the leading eigenvalues by
bisection on Sturm counts and their vectors by inverse iteration, made orthogonal inside clusters of close
eigenvalues. Components and means are broadcast and every row is projected where it lies.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.vectors import dimension_of, scaled

SCALE, SHIFT, LIMIT = 1024, 100_000, 1 << 31
EPS = float(np.finfo(float).eps)


class Whitening(NamedTuple):
    n: int
    sums: list[int]             # of x, by dimension
    covariance: np.ndarray
    eigenvalues: np.ndarray     # leading ones, falling
    components: np.ndarray      # one a row
    trace: float

    @property
    def centre(self) -> np.ndarray:
        """The integers next to the means, which are taken off before anything is multiplied."""
        return np.array([round(Fraction(s, self.n)) for s in self.sums], dtype=np.int64)

    @property
    def rest(self) -> np.ndarray:
        """n times what the means exceed those integers by."""
        return np.array([s - self.n * int(m) for s, m in zip(self.sums, self.centre)], dtype=np.int64)


def _added(df: DataFrame, vec_col: str, dims: int, of_batch) -> np.ndarray:
    """Sum over all rows of ``of_batch(x)``, a vector of integers or doubles of each batch's rows. Tasks add
    up their batches; the tasks' vectors are added place by place on the cluster."""
    def run(batches):
        total = None
        for batch in batches:
            _, z = scaled(batch.column(0), dims, SCALE, LIMIT)
            if len(z):
                part = of_batch(z + SHIFT)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({
                "place": pa.array(np.arange(len(total), dtype=np.int32)),
                "whole": pa.array([Decimal(int(v)) for v in total] if total.dtype == object else [None] * len(total), pa.decimal128(38, 0)),
                "real": pa.array([None] * len(total) if total.dtype == object else total, pa.float64())})

    parts = df.select(vec_col).mapInArrow(run, "place int, whole decimal(38,0), real double")
    out = parts.groupBy("place").agg(F.sum("whole").alias("whole"), F.sum("real").alias("real")).orderBy("place").collect()
    return np.array([r["real"] if r["whole"] is None else int(r["whole"]) for r in out], dtype=object)


def _products(y: np.ndarray) -> np.ndarray:
    """Upper triangle of y'y in exact integers."""
    most = int(np.abs(y).max(initial=0)) ** 2 * len(y)
    if most < 1 << 53:
        g = (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64).astype(object)
    elif most < 1 << 62:
        g = (y.T @ y).astype(object)
    else:
        g = y.astype(object).T @ y.astype(object)
    return g[np.triu_indices(y.shape[1])]


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, side diagonal and Householder vectors (None: nothing to reflect) of a symmetric matrix."""
    a, vectors, scale = a.copy(), [], np.abs(a).max()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        if np.abs(x[1:]).max() <= EPS * EPS * scale:
            vectors.append(None)
            continue
        side = -np.copysign(np.linalg.norm(x), x[0])
        x[0] -= side
        x /= np.linalg.norm(x)
        vectors.append(x)
        block = a[k + 1:, k + 1:]
        p = block @ x
        w = p - (x @ p) * x
        block -= 2 * (np.outer(x, w) + np.outer(w, x))
        a[k + 1, k] = side
    return np.diag(a).copy(), np.diag(a, -1).copy(), vectors


def eigenvalues_below(diagonal: np.ndarray, side: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of the tridiagonal matrix lie below each value."""
    least = EPS * max(np.abs(diagonal).max(), np.abs(side).max(initial=0)) ** 2 * EPS + np.finfo(float).tiny
    count, q = np.zeros(len(at), dtype=np.int64), np.ones(len(at))
    for k, d in enumerate(diagonal):
        q = d - at - (side[k - 1] ** 2 / q if k else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, side: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest, falling, each bisected to the last bits."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0], side])) + np.abs(np.concatenate([side, [0]]))
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    high += 2 * EPS * np.abs(high) + np.finfo(float).tiny
    rank = n - 1 - np.arange(k)  # how many are smaller
    for _ in range(200):
        mid = low + (high - low) / 2
        if np.all((mid <= low) | (mid >= high)):
            break
        over = eigenvalues_below(diagonal, side, mid) > rank
        high, low = np.where(over, mid, high), np.where(over, low, mid)
    return low + (high - low) / 2


def _solver(diagonal: np.ndarray, side: np.ndarray, shift: float):
    """x -> (T - shift)^-1 x, by elimination with row exchanges; a zero pivot becomes a tiny one."""
    n = len(diagonal)
    tiny = EPS * max(np.abs(diagonal).max(), np.abs(side).max(initial=0), np.finfo(float).tiny)
    d, up, up2 = (diagonal - shift).tolist(), side.tolist() + [0.0], [0.0] * n
    steps = []
    for k in range(n - 1):
        below, exchange = float(side[k]), abs(side[k]) > abs(d[k])
        if exchange:
            d[k], below = below, d[k]
            up[k], d[k + 1] = d[k + 1], up[k]
            if k < n - 2:
                up2[k], up[k + 1] = up[k + 1], 0.0
        if d[k] == 0:
            d[k] = tiny
        factor = below / d[k]
        d[k + 1] -= factor * up[k]
        if k < n - 2:
            up[k + 1] -= factor * up2[k]
        steps.append((exchange, factor))
    if abs(d[-1]) < tiny:
        d[-1] = tiny

    def solve(x: np.ndarray) -> np.ndarray:
        x = x.tolist()
        for k, (exchange, factor) in enumerate(steps):
            if exchange:
                x[k], x[k + 1] = x[k + 1], x[k]
            x[k + 1] -= factor * x[k]
        for k in range(n - 1, -1, -1):
            after = (up[k] * x[k + 1] if k < n - 1 else 0.0) + (up2[k] * x[k + 2] if k < n - 2 else 0.0)
            x[k] = (x[k] - after) / d[k]
        return np.array(x)

    return solve


def tridiagonal_vectors(diagonal: np.ndarray, side: np.ndarray, values: np.ndarray, close: float = 1e-3) -> np.ndarray:
    """Unit eigenvectors, one a row. Values nearer to their neighbour than ``close`` of the matrix form a
    cluster: they are moved apart by a few bits, and every step of a vector is made orthogonal to the
    cluster's earlier ones."""
    n, norm = len(diagonal), max(np.abs(diagonal).max(), np.abs(side).max(initial=0))
    out, start, moved = np.zeros((len(values), n)), 0, np.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > close * norm:
            start = k
            moved = np.inf
        moved = min(value, moved - 4 * EPS * norm)
        solve = _solver(diagonal, side, moved)
        x = 1.0 + np.cos((k + 1) * np.arange(1, n + 1)) / 2  # a fixed start that no vector is orthogonal to
        for _ in range(6):
            x /= np.abs(x).max()
            x = solve(x)
            x /= np.abs(x).max()
            for _ in range(2):
                x -= out[start:k].T @ (out[start:k] @ x)
            x /= np.linalg.norm(x)
        out[k] = x
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors (rows); the largest
    entry of a vector is positive."""
    k = min(k, len(matrix))
    scale = np.abs(matrix).max(initial=0)
    if not k or not scale:
        return np.zeros(k), np.eye(k, len(matrix))
    diagonal, side, reflections = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, side, k)
    vectors = tridiagonal_vectors(diagonal, side, values)
    for j in range(len(reflections) - 1, -1, -1):
        if (v := reflections[j]) is not None:
            vectors[:, j + 1:] -= 2 * np.outer(vectors[:, j + 1:] @ v, v)
    vectors *= np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])[:, None]
    return values * scale, vectors


def fit_whitening(df: DataFrame, components: int = 8, vec_col: str = "embedding") -> Whitening:
    """Fit on all rows that take part. Components whose eigenvalue is zero to rounding are left out."""
    dims = dimension_of(df, vec_col)
    first = _added(df, vec_col, dims, lambda x: np.concatenate([[len(x)], x.sum(axis=0)]).astype(object))
    if not len(first):
        return Whitening(0, [0] * dims, np.zeros((dims, dims)), np.zeros(0), np.zeros((0, dims)), 0.0)
    n, sums = int(first[0]), [int(s) for s in first[1:]]
    plain = Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), np.zeros((0, 0)), 0.0)
    centre, rest = plain.centre, [int(r) for r in plain.rest]
    upper = _added(df, vec_col, dims, lambda x: _products(x - centre))
    covariance = np.zeros((dims, dims))
    for i, j, s in zip(*np.triu_indices(dims), upper):
        covariance[i, j] = covariance[j, i] = float(Fraction(n * int(s) - rest[i] * rest[j], n * n))
    values, vectors = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    real = values > max(n, dims) * EPS * trace
    return Whitening(n, sums, covariance, values[real], vectors[real], trace)


def _white(model: Whitening, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centred rows and their whitened components."""
    off = (x - model.centre) - model.rest / model.n
    return off, off @ (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(df: DataFrame, model: Whitening, vec_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from the rows themselves."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0

    def moments(x):
        w = _white(model, x)[1]
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = _added(df, vec_col, len(model.sums), moments).astype(float) / model.n
    mean, second = total[:k], total[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row per vector and component: the identifier, component (from 1), n, deviation, whitened, explained.

    x = floor(1024 * entry) + 100000. Rows whose vector is null, has null or non-finite entries, entries of two
    million or more, or another length than most take no part, neither here nor in the fit. Identifiers may be
    null or repeated: each row is projected. ``deviation`` is null where it exceeds a long. An empty table,
    a single vector or equal vectors have no component and give no rows; other columns are not read.
    """
    spark = df.sparkSession
    shared, dims, k = spark.sparkContext.broadcast(model), len(model.sums), len(model.eigenvalues)

    def run(batches):
        model = shared.value
        for batch in batches:
            at, z = scaled(batch.column(1), dims, SCALE, LIMIT)
            if not len(at) or not k:
                continue
            x = z + SHIFT
            _, white = _white(model, x)
            wide = (x - model.centre).astype(float) * model.n - model.rest
            about = (wide ** 2).sum(axis=1)
            exact = [None] * len(at)
            near = np.flatnonzero(about < 2.0 ** 64)  # there every term is below 2**33
            t = (x[near] - model.centre) * model.n - model.rest
            small = about[near] < 2.0 ** 62
            for i, v in zip(near[small].tolist(), (t[small] ** 2).sum(axis=1).tolist()):
                exact[i] = v
            for i, row in zip(near[~small].tolist(), t[~small].tolist()):
                v = sum(c * c for c in row)
                exact[i] = v if v < 1 << 63 else None
            rows = np.repeat(np.arange(len(at)), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(at[rows])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                pa.array(np.full(len(rows), model.n)), pa.array(exact, pa.int64()).take(pa.array(rows)), pa.array(white.ravel()),
                pa.array(np.tile(model.eigenvalues / model.trace, len(at)))], names=["id", "component", "n", "deviation", "whitened", "explained"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).mapInArrow(
        run, f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double")
    return out.withColumnRenamed("id", id_col)
