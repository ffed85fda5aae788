"""Gram-matrix linear models against NumPy closed forms."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import models as G


def _data(spark, n=400):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 2))
    y = 1.5 + x @ np.array([2.0, -1.0]) + rng.normal(scale=0.3, size=n)
    rows = [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, a double, b double, y double"), x, y


def test_ridge_matches_closed_form(spark):
    df, x, y = _data(spark)
    w, b = G.solve_ridge(G.gram_by(df, ["a", "b"], "y")[None], 2.0)
    xc, yc = x - x.mean(0), y - y.mean()
    w_ref = np.linalg.solve(xc.T @ xc + 2.0 * np.eye(2), xc.T @ yc)
    assert np.allclose(w, w_ref) and np.isclose(b, y.mean() - x.mean(0) @ w_ref)


def test_cross_validate_matches_refits(spark):
    df, x, y = _data(spark)
    folds = df.select("row_id", (F.col("row_id") % 4).alias("fold"))
    out = {r.fold: r for r in G.cross_validate_linear(df, folds, "row_id", ["a", "b"], "y").collect()}
    fold = np.arange(len(y)) % 4
    for f in range(4):
        tr, te = fold != f, fold == f
        X = np.c_[np.ones(tr.sum()), x[tr]]
        beta = np.linalg.lstsq(X, y[tr], rcond=None)[0]
        pred = np.c_[np.ones(te.sum()), x[te]] @ beta
        assert np.isclose(out[f].rmse, np.sqrt(np.mean((y[te] - pred) ** 2)), rtol=1e-8)


def test_grid_search_picks_lowest_rmse(spark):
    df, _, _ = _data(spark)
    tr, va = df.where("row_id % 5 <> 0"), df.where("row_id % 5 = 0")
    res = G.grid_search_ridge(tr, va, ["a", "b"], "y", [0.0, 1.0, 1e6]).collect()
    best = [r for r in res if r.best][0]
    assert best.rmse == min(r.rmse for r in res) and best.alpha != 1e6


def test_gram_models_keep_digits_of_large_means(spark):
    """Feature mean 1e9 with spread 1 and slope 2: raw sums of products lose the slope."""
    from quarry.operators.models import cross_validate_linear, fit_ridge_classifier, grid_search_ridge
    from quarry.operators.splits import kfold_assign
    rng = np.random.default_rng(3)
    x = 1e9 + rng.normal(size=400)
    df = spark.createDataFrame([(i, float(v), float(2 * (v - 1e9) + 5)) for i, v in enumerate(x)], "row_id bigint, x double, y double")
    cv = {r.fold: r for r in cross_validate_linear(df, kfold_assign(df, "row_id", 4), "row_id", ["x"], "y").collect()}
    assert cv[-1].r2 > 0.999999
    best = [r for r in grid_search_ridge(df, df, ["x"], "y", [0.0, 100.0]).collect() if r.best]
    assert best[0].alpha == 0.0 and best[0].r2 > 0.999999
    w, b = fit_ridge_classifier(df.selectExpr("x", "CAST(x > 1e9 AS INT) AS c"), ["x"], "c", 0.0)
    assert np.mean(((w[0] * (x - 1e9) + (b + w[0] * 1e9)) > 0) == (x > 1e9)) > 0.95


def test_roc_auc_counts_beyond_bigint_products(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select((F.lit(4_000_000_000).cast("double") * F.lit(4_000_000_000).cast("double")).alias("p")).first().p
    assert got == 1.6e19


def test_wide_draws_reach_beyond_32_bits(spark):
    from quarry.functions.hashing import hash_wide
    got = [r.h for r in spark.range(200).select(hash_wide(0, "id").alias("h")).collect()]
    assert max(got) > 2 ** 58 and min(got) >= 0
