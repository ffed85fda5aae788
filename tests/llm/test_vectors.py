"""Whitening and hard negatives against plain numpy, on small tables with nulls, ties, repeats and odd vectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm.common import ship_package
from quarry.llm.hard_negatives import mine_hard_negatives, spanning_tree, window_scores
from quarry.llm.whitening import eigenvalues_below, fit_whitening, identity_error, leading_components, tridiagonal, whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table_of(spark, rows):
    ship_package(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("n", "component", "tag", "x", "block", "chunk", "salt", "id", "score", "rank"):
        df = df.withColumn(name, F.lit("clash"))
    return df.repartition(5)


def odd_rows(seed, n, dims, clusters=3):
    """Clustered vectors with repeats, ties, null and repeated identifiers, and rows that take no part."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clusters, dims))
    rows = []
    for i in range(n):
        v = (centres[i % clusters] + 0.3 * r.normal(size=dims)).astype(np.float32).tolist()
        rows.append((i, v, int(r.integers(0, 4))))
    rows += [(1000 + i, rows[5 * i][1], rows[5 * i][2]) for i in range(8)]  # equal vectors: ties
    rows += [rows[0], rows[10], (10, rows[3][1], 1), (None, rows[1][1], rows[1][2]), (None, rows[2][1], 0)]
    rows += [(2000, None, 1), (2010, [None] + [1.0] * (dims - 1), 1), (2020, [math.nan] * dims, 1), (2030, [math.inf] * dims, 1),
             (2040, [1.0], 1), (2050, [], 1), (2060, [3e38] * dims, 1), (2070, rows[0][1], None)]
    return rows


def fits(v, dims):
    return v is not None and len(v) == dims and all(c is not None and abs(c) < 1e6 for c in v)


@pytest.mark.parametrize("dims,kind", [(1, "full"), (2, "full"), (5, "equal"), (12, "full"), (40, "low"), (40, "double"), (30, "same"), (9, "zero")])
def test_components_equal_a_dense_solver(dims, kind):
    r = np.random.default_rng(dims)
    m = r.normal(size=(200, dims))
    if kind == "low":
        m = m[:, :4] @ r.normal(size=(4, dims))
    if kind == "equal":
        m[:, 1:] = m[:, :1]
    v = np.cov(m.T, bias=True).reshape(dims, dims)
    if kind == "double":  # pairs of equal eigenvalues: clusters
        q = np.linalg.qr(r.normal(size=(dims, dims)))[0]
        v = q @ np.diag(np.repeat(np.arange(dims // 2, 0, -1.0), 2)) @ q.T
        v = (v + v.T) / 2
    if kind == "same":
        v = 3 * np.eye(dims)
    if kind == "zero":
        v = np.zeros((dims, dims))
    values, rows = leading_components(v, 8)
    right = np.linalg.eigvalsh(v)[::-1][:8]
    top = max(right[0], 1e-300)
    assert np.abs(values - right).max() <= 1e-13 * top
    assert np.abs(v @ rows.T - rows.T * values).max() <= 1e-13 * top
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() <= 1e-12


def test_sturm_counts():
    r = np.random.default_rng(3)
    a = r.normal(size=(30, 30))
    a = a + a.T
    diagonal, side, _ = tridiagonal(a)
    at = np.linspace(-12, 12, 41)
    assert eigenvalues_below(diagonal, side, at).tolist() == [int((np.linalg.eigvalsh(a) < t).sum()) for t in at]


@pytest.mark.parametrize("dims", [3, 12])
def test_whitening_equals_brute_force(spark, dims):
    rows = odd_rows(dims, 120, dims)
    df = table_of(spark, rows)
    model = fit_whitening(df)
    got = sorted(whiten(df, model).collect(), key=lambda r: (r["vec_id"] is None, r["vec_id"], r["deviation"], r["component"]))
    some = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v, _ in rows if fits(v, dims)]
    n, x = len(some), np.array([v for _, v in some], dtype=object)
    sums = [int(s) for s in x.sum(axis=0)]
    assert (model.n, model.sums) == (n, sums)
    v = np.array([[float(Fraction(sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) * n - sums[i] * sums[j], n * n)) for j in range(dims)] for i in range(dims)])
    assert np.allclose(model.covariance, v, rtol=1e-14)
    e, q = np.linalg.eigh(v)
    k = min(8, dims)
    e, q = e[::-1][:k], q[:, ::-1][:, :k].T
    off = np.array([[float(Fraction(int(c)) - Fraction(s, n)) for c, s in zip(row, sums)] for row in x])
    white = off @ q.T / np.sqrt(e)
    white *= np.sign((q * model.components).sum(axis=1))
    want = sorted(((i, c + 1, sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)), white[r, c], e[c] / np.trace(v))
                   for r, (i, row) in enumerate(some) for c in range(k)), key=lambda t: (t[0] is None, t[0], t[2], t[1]))
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [(t[0], t[1], n, t[2]) for t in want]
    assert np.allclose([(r["whitened"], r["explained"]) for r in got], [t[3:] for t in want], rtol=1e-9, atol=1e-9)
    assert identity_error(df, model) < 1e-9


def test_whitening_of_few_or_equal_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)], [(1, None, 0)], [(1, [], 0)]):
        df = table_of(spark, rows)
        model = fit_whitening(df)
        assert whiten(df, model).collect() == [] and identity_error(df, model) == 0
    line = table_of(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)])  # one direction only
    model = fit_whitening(line)
    assert {r["component"] for r in whiten(line, model).collect()} == {1} and identity_error(line, model) < 1e-9


def test_deviation_beyond_a_long_is_null(spark):
    df = table_of(spark, [(i, [float(2 * (i % 2) - 1) * 1_900_000, 0.0], 0) for i in range(20)])
    got = whiten(df, fit_whitening(df)).collect()
    assert len(got) == 20 and {r["deviation"] for r in got} == {None}


def test_tree_bounds_lose_no_score():
    r = np.random.default_rng(7)
    centres = r.normal(size=(6, 16)) * 300
    x = np.floor(centres[r.integers(0, 6, 80)] + 5 * r.normal(size=(80, 16)))
    c = np.floor(centres[r.integers(0, 6, 500)] + 5 * r.normal(size=(500, 16)))
    tree = spanning_tree(x)
    assert sorted(np.concatenate(tree[2]).tolist()) == list(range(80))
    scores = x @ c.T
    low, high = np.quantile(scores, 0.97, axis=1), np.quantile(scores, 0.99, axis=1)
    visited = {}
    for v, places, found in window_scores(x, tree, c, np.sqrt((c ** 2).sum(axis=1)), low, high):
        visited[v] = sorted(zip(places.tolist(), found.tolist()))
    assert visited == {v: [(j, s) for j, s in enumerate(scores[v]) if low[v] <= s <= high[v]] for v in range(80)}


def brute_negatives(rows, dims, every):
    some = [(i, label, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, label in rows
            if label is not None and fits(v, dims)]
    out = []
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    order = lambda t: (-t[0], t[1] is None, t[1])
    for a, (i, label, v) in enumerate(some):
        if i is None or i % every:
            continue
        pos = sorted(((dot(v, w), j) for b, (j, l, w) in enumerate(some) if b != a and l == label), key=order)[:5]
        neg = sorted(((dot(v, w), j) for j, l, w in some if l != label), key=order)
        for s, j in pos:
            for rank, (t, m) in enumerate([(t, m) for t, m in neg if 50 * s <= 100 * t <= 95 * s][:3], 1):
                out.append((i, j, rank, m, s, t))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(8192, 8192), (17, 6)])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rows = odd_rows(11, 150, 10)
    df = table_of(spark, rows)
    got = mine_hard_negatives(df, lambda i: i % 5 == 0, chunk_rows=sizes[0], block_rows=sizes[1])
    want = brute_negatives(rows, 10, 5)
    assert len(want) > 100 and sorted((tuple(r) for r in got.collect()), key=str) == want


def test_hard_negatives_of_large_components_are_exact(spark):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=6) * 9000).clip(-16000, 16000).astype(np.float32).tolist(), int(i % 3)) for i in range(60)]
    got = mine_hard_negatives(table_of(spark, rows), lambda i: i % 5 == 0)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_negatives(rows, 6, 5)


def test_hard_negatives_of_empty_and_lonely_tables(spark):
    for rows in ([], [(0, [1.0], 0)], [(1, [1.0], 0), (2, [1.0], 1)], [(0, None, 0)], [(0, [1.0], None)], [(0, [1.0], 0), (5, [1.0], 1)]):
        assert mine_hard_negatives(table_of(spark, rows), lambda i: i % 5 == 0).collect() == []
