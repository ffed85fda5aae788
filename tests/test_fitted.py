"""Quantile brackets, null keys, sparse one-hot, Newton fits, bundles, neighbours, bootstrap and gated scoring
against numpy or plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.ranking import exact_quantiles
from quarry.operators import bootstrap as B
from quarry.operators import bundle as BU
from quarry.operators import models as G
from quarry.operators import neighbours as N
from quarry.operators import preprocess as P
from quarry.operators import splits as E
from quarry.streaming import scoring as L


# ------------------------------------------------------------------ quantiles
def test_quantiles_between_brackets_equal_numpy(spark):
    """accuracy 100 puts every group above 200 values through sketch brackets."""
    r = np.random.default_rng(1)
    groups = {"wide": r.normal(size=5000), "ties": r.integers(0, 7, 4000).astype(float), "hot": np.r_[np.full(3000, 2.5), r.normal(size=900)],
              "few": r.normal(size=11), "one": np.array([3.0]), None: r.exponential(size=1500)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("wide", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    qs = [0.0, 0.05, 0.25, 0.5, 0.777, 0.95, 1.0]
    got = {(r.g, r.qi): r.value for r in exact_quantiles(df, ["g"], "v", qs, accuracy=100).collect()}
    want = {(g, i): float(np.quantile(vs, q)) for g, vs in groups.items() for i, q in enumerate(qs)}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


# ------------------------------------------------------------------ null keys
def test_null_keys_keep_every_row(spark):
    rows = [(i, None if i % 10 == 0 else f"g{i % 4}") for i in range(100)]
    df = spark.createDataFrame(rows, "row_id bigint, y string")
    assert E.split_group(df, "row_id", "y", 0.3).count() == 100
    strat = {r.split: r["count"] for r in E.split_stratified(df, "row_id", "y", 0.2).groupBy("split").count().collect()}
    assert sum(strat.values()) == 100 and strat["val"] == sum(math.ceil(n * 0.2) for n in (10, 20, 20, 25, 25))
    assert E.kfold_assign(df, "row_id", 5, label="y").count() == 100
    sizes = lambda d: {r.y: r["count"] for r in d.groupBy("y").count().collect()}
    assert sizes(G.oversample(df, "y", "row_id")) == {k: 25 for k in (None, "g0", "g1", "g2", "g3")}
    assert sizes(G.undersample(df, "y", "row_id")) == {k: 10 for k in (None, "g0", "g1", "g2", "g3")}


# ------------------------------------------------------------------ one-hot
def test_sparse_onehot_equals_dense(spark):
    train = spark.createDataFrame([("b", 1), ("a", 2), (None, 1), ("c", None)], "x string, y int")
    df = spark.createDataFrame([(0, "a", 1), (1, None, 2), (2, "new", 1), (3, "c", None), (4, "new", 9)], "row_id int, x string, y int")
    dense = P.apply_onehot(df, P.fit_onehot(train, ["x", "y"])).orderBy("row_id").collect()
    names = [c for c in dense[0].asDict() if c.startswith("cat__")]
    sparse = P.apply_onehot_sparse(df, P.onehot_dictionary(train, ["x", "y"]), ["x", "y"]).orderBy("row_id").collect()
    for d, s in zip(dense, sparse):
        full = [0.0] * s["cat__size"]
        for i, v in zip(s["cat__indices"], s["cat__values"]):
            full[i] = v
        assert full == [d[n] for n in names] and s["cat__indices"] == sorted(s["cat__indices"])


def test_sparse_onehot_of_many_categories(spark):
    n = 300_000
    df = spark.range(n).select(F.col("id").alias("row_id"), F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("x"))
    with pytest.raises(ValueError):
        P.fit_onehot(df, ["x"])
    out = P.apply_onehot_sparse(df, P.onehot_dictionary(df, ["x"]), ["x"])
    r = out.agg(F.min("cat__size"), F.sum((F.col("cat__indices")[0] == F.col("row_id")).cast("int")), F.sum(F.size("cat__indices"))).first()
    assert tuple(r) == (n, n, n)


# ------------------------------------------------------------------ Newton
def numpy_logistic(x, y, k, l2, w=None):
    w = np.ones(len(y)) if w is None else w
    a = np.c_[np.ones(len(x)), x]
    d = a.shape[1]
    b = np.zeros((1 if k == 2 else k, d))
    pen = np.tile(np.r_[0.0, np.full(d - 1, l2)], len(b))
    for _ in range(60):
        z = a @ b.T
        p = 1 / (1 + np.exp(-z)) if k == 2 else np.exp(z - z.max(1, keepdims=True)) / np.exp(z - z.max(1, keepdims=True)).sum(1, keepdims=True)
        hit = (y[:, None] == (np.array([1]) if k == 2 else np.arange(k))[None]).astype(float)
        grad = ((p - hit) * w[:, None]).T @ a
        hess = np.block([[(a * (w * p[:, i] * ((i == j) - p[:, j]))[:, None]).T @ a for j in range(len(b))] for i in range(len(b))])
        b = b - (np.linalg.pinv(hess + np.diag(pen)) @ (grad.ravel() + pen * b.ravel())).reshape(b.shape)
    return b


def test_newton_fits_equal_numpy(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(300, 2))
    y3 = (x @ r.normal(size=(2, 3)) + r.gumbel(size=(300, 3))).argmax(1)
    y2, w, fold = (y3 > 0).astype(int), r.uniform(0.2, 2, 300), r.integers(0, 3, 300)
    rows = [(i, *map(float, x[i]), int(y2[i]), int(y3[i]), float(w[i]), int(fold[i])) for i in range(300)] + [(300, None, 1.0, 1, 1, 1.0, 0), (301, 1.0, 1.0, None, None, 1.0, 0)]
    df = spark.createDataFrame(rows, "row_id int, a double, b double, y2 int, y3 int, w double, fold int").repartition(4)
    assert np.allclose(G.newton_logistic(df, ["a", "b"], "y2", 2, 1.0)[0], numpy_logistic(x, y2, 2, 1.0), atol=1e-8)
    assert np.allclose(G.newton_logistic(df, ["a", "b"], "y2", 2, 0.5, weight_col="w")[0], numpy_logistic(x, y2, 2, 0.5, w), atol=1e-8)
    three = G.newton_logistic(df, ["a", "b"], "y3", 3, 0.7)[0]
    want = numpy_logistic(x, y3, 3, 0.7)
    assert np.allclose(three - three.mean(0), want - want.mean(0), atol=1e-7)
    folds = G.newton_logistic(df, ["a", "b"], "y2", 2, 1.0, fold_col="fold", folds=3)
    for k in range(3):
        assert np.allclose(folds[k], numpy_logistic(x[fold != k], y2[fold != k], 2, 1.0), atol=1e-8)


def test_elastic_net_meets_its_optimality_conditions(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(400, 4)) @ r.normal(size=(4, 4))
    y = x @ np.array([2.0, 0.0, -1.0, 0.1]) + 1000 + r.normal(size=400)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], "a double, b double, c double, d double, y double")
    for kind, l1, l2 in (("lasso", 0.3, 0.0), ("elasticnet", 0.15, 0.15)):
        w, b = G.fit_linear_gram(df, list("abcd"), "y", kind, 0.3)
        grad = x.T @ (y - x @ w - b) / 400 - l2 * w
        assert abs((y - x @ w - b).mean()) < 1e-8
        assert all(abs(g - l1 * np.sign(v)) < 1e-7 if v else abs(g) <= l1 + 1e-7 for g, v in zip(grad, w)) and 0 < np.count_nonzero(w) <= 4


# ------------------------------------------------------------------ bundles
def people(spark, n=400):
    r = random.Random(2)
    rows = []
    for i in range(n):
        a, c = (None if i % 17 == 0 else r.gauss(0, 1)), r.choice(["x", "y.z", None])
        rows.append((i, a, r.gauss(5, 2), c, f"k{r.randrange(60)}", (a or 0) * 2 + (c == "x") + r.gauss(0, 0.1), "yes" if (a or 0) > 0.2 else "no", r.choice(["p", "q", "r"])))
    return spark.createDataFrame(rows, "row_id int, a double, `b.c` double, cat string, many string, y double, bin string, tri string")


@pytest.mark.parametrize("target,task,model,extra", [
    ("y", "regression", "ridge", dict(conformal_alpha=0.1)), ("y", "regression", "random_forest", dict(params={"numTrees": 4})),
    ("bin", "classification", "logistic", dict(threshold_metric="f1")), ("tri", "classification", "random_forest", dict(params={"numTrees": 4}))])
def test_a_saved_bundle_scores_as_the_fitted_one(spark, tmp_path, target, task, model, extra):
    df = people(spark)
    train, valid = df.where("row_id % 4 > 0"), df.where("row_id % 4 = 0")
    fitted = BU.fit_bundle(train, target, ["a", "b.c"], ["cat", "many"], task, model, validation=valid,
                           encoding={"cat": "onehot", "many": "frequency" if model != "ridge" else "target_mean"}, **extra)
    back = BU.load_bundle(spark.newSession(), BU.save_bundle(fitted, f"{tmp_path}/b"))
    new = df.drop("y", "bin", "tri").unionByName(spark.createDataFrame([(9999, None, None, "unseen", None)], "row_id int, a double, `b.c` double, cat string, many string"))
    one, two = (sorted(tuple(r) for r in b.score(new).collect()) for b in (fitted, back))
    assert one == two and len(one) == 401 and all(v is not None for row in one for v in row)
    if task == "classification":
        n = 2 if target == "bin" else 3
        assert all(math.isclose(sum(row[1 : 1 + n]), 1, rel_tol=1e-9) for row in one) and ("threshold" in fitted.spec) == (n == 2)
    if model == "ridge":
        hit = {r.row_id: r.y for r in valid.collect()}
        inside = [lo <= hit[i] <= hi for i, _, lo, hi in one if i in hit]
        assert 0.88 <= np.mean(inside) <= 0.93


def test_the_train_task_in_one_program(spark, tmp_path):
    from quarry.operators.train import train_task
    df = people(spark)
    split = df.select("row_id", F.when(F.col("row_id") % 4 == 0, "val").otherwise("train").alias("split"))
    got = train_task(df, split, "row_id", "bin", ["a"], ["cat"], f"{tmp_path}/t", "classification", "logistic", "class_weight", threshold_metric="f1", n_boot=10, cv_folds=3)
    assert got.predictions.count() == 100 and got.report.where("label = 'accuracy'").first()["recall"] > 0.9
    ci = got.interval.first()
    assert 0.9 < ci.low <= ci.mid <= ci.high <= 1 and got.folds.where("fold >= 0").count() == 3
    with pytest.raises(ValueError):
        train_task(df, split, "row_id", "y", ["a"], [], f"{tmp_path}/u", imbalance="oversample")


def test_bundles_refuse_what_they_cannot_fit(spark):
    df = people(spark, 40)
    for bad in (dict(task="ranking"), dict(model="logistic"), dict(encoding="onehot_sparse"), dict(task="classification", model="ols")):
        with pytest.raises(ValueError):
            BU.fit_bundle(df, "y", ["a"], ["cat"], **bad)


# ------------------------------------------------------------------ neighbours
@pytest.mark.parametrize("pivots,rows", [(1, 10_000), (16, 10_000), (40, 15)])
def test_neighbours_equal_brute_force(spark, pivots, rows):
    """Clusters, equal rows and a cell with a third of all rows, in parts of 15 rows in the last case."""
    r = np.random.default_rng(3)
    x = np.r_[r.normal(size=(200, 3)), np.tile([[5.0, 5, 5]], (100, 1)), 9 + 0.1 * r.normal(size=(60, 3))]
    train = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)] + [(900, None, 1.0, 1.0), (901, math.nan, 1.0, 1.0)], "row_id int, a double, b double, c double")
    q = np.r_[x[::9], r.normal(size=(20, 3)) * 4]
    asked = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(q)], "row_id int, a double, b double, c double").repartition(3)
    got = N.nearest_neighbours(train, asked, ["a", "b", "c"], 4, pivots=pivots, part_rows=rows, visit_rows=rows)
    want = {}
    for i, v in enumerate(q):
        d = np.sqrt(((x - v) ** 2).sum(1))
        for rank, j in enumerate(np.lexsort((np.arange(len(x)), d))[:4], 1):
            want[i, rank] = (int(j), round(float(d[j]), 9))
    assert {(r.id, r.rank): (r.neighbour, round(r.distance, 9)) for r in got.collect()} == want


def test_neighbours_of_tiny_tables(spark):
    schema = "row_id int, a double"
    one, none = spark.createDataFrame([(1, 2.0)], schema), spark.createDataFrame([], schema)
    assert [tuple(r) for r in N.nearest_neighbours(one, one, ["a"], 3).collect()] == [(1, 1, 0.0, 1)]
    assert N.nearest_neighbours(none, one, ["a"]).collect() == [] and N.nearest_neighbours(one, none, ["a"]).collect() == []


def test_rbf_separates_a_ring(spark):
    r = random.Random(4)
    points = [(r.gauss(0, 1), r.gauss(0, 1)) for _ in range(600)]
    points = [(a, b) for a, b in points if not 0.5 < math.hypot(a, b) < 0.7 and not 1.5 < math.hypot(a, b) < 1.8]
    df = spark.createDataFrame([(i, a, b, float(0.6 < math.hypot(a, b) < 1.6)) for i, (a, b) in enumerate(points)], "row_id int, a double, b double, y double").coalesce(2)
    model, names, gamma = N.fit_rbf_svc(df, ["a", "b"], "y", gamma=1.0, components=50, c=50.0)
    ready, _ = N.fourier_features(df, ["a", "b"], gamma, 50)
    right = model.transform(G.assemble(ready, names)).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    w, b = G.fit_ridge_classifier(df, ["a", "b"], "y")  # a straight line
    line = df.agg(F.avg(((F.col("a") * float(w[0]) + F.col("b") * float(w[1]) + float(b) >= 0) == (F.col("y") == 1)).cast("double"))).first()[0]
    assert right > 0.95 and line < 0.75


# ------------------------------------------------------------------ bootstrap
def test_bootstrap_of_ranks_with_a_hot_score_equals_numpy(spark):
    r = np.random.default_rng(8)
    s = np.where(r.uniform(size=3000) < 0.4, 0.5, np.round(r.uniform(size=3000), 3))
    y = (r.uniform(size=3000) < s).astype(int)
    df = spark.createDataFrame([(i, int(b), float(a)) for i, (a, b) in enumerate(zip(s, y))], "row_id int, y_true int, p double").repartition(5)
    from quarry.functions.hashing import hash_wide
    base = np.array([x.h for x in df.select("row_id", hash_wide(1, "row_id").alias("h")).orderBy("row_id").collect()])
    w = B.row_weights(base, B.replicate_factors(1, 12))
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.06
    auc, ap = [], []
    for k in range(12):
        pos, neg = ({v: float((w[:, k] * (s == v) * (y == c)).sum()) for v in sorted(set(s))} for c in (1, 0))
        below = u = 0.0
        for v in pos:
            u += pos[v] * (below + neg[v] / 2)
            below += neg[v]
        auc.append(u / (sum(pos.values()) * below))
        tp = fp = a = 0.0
        for v in reversed(list(pos)):
            tp, fp = tp + pos[v], fp + neg[v]
            a += pos[v] * tp / (tp + fp) if pos[v] else 0
        ap.append(a / tp)
    for metric, reps in (("roc_auc", auc), ("pr_auc", ap)):
        got = B.bootstrap_ci_proba(df, metric, n_boot=12, seed=1).first()
        assert np.allclose([got.low, got.high], np.quantile(reps, [0.025, 0.975])) and got.low < got.mid < got.high and got.n_boot == 12


# ------------------------------------------------------------------ gated scoring
def files(spark, path, n=4):
    for k in range(n):
        spark.range(k * 10, k * 10 + 10).select(F.col("id"), (F.col("id") * 1.0).alias("v")).coalesce(1).write.mode("append").parquet(f"{path}/in{k}")


def test_scoring_goes_on_after_a_crash_without_loss_or_repeat(spark, tmp_path):
    files(spark, tmp_path)
    stream = lambda: L.file_stream(spark, f"{tmp_path}/in*", "id bigint, v double")
    calls, state = [], f"{tmp_path}/state"

    def score(batch):
        calls.append(1)
        out = batch.select("id", (F.col("v") * 2).alias("prediction"))
        if len(calls) == 3:  # the third batch leaves predictions without a manifest entry
            out.write.parquet(f"{state}/out/v=2")
            raise RuntimeError("the driver is gone")
        return out

    with pytest.raises(Exception, match="the driver is gone"):
        L.score_exactly_once(stream(), score, state, {"big": F.expr("v >= 25")})
    assert L.finished_batches(spark, state).count() == 2
    out = L.score_exactly_once(stream(), score, state, {"big": F.expr("v >= 25")})
    assert sorted((r.id, r.prediction) for r in out.collect()) == [(i, 2.0 * i) for i in range(40)]
    done = [tuple(r)[:6] for r in L.finished_batches(spark, state).orderBy("chunk").collect()]
    assert [d[:5] for d in done] == [(k, 10 * k, 10 * k + 10, 10, 10) for k in range(4)] and sum(d[5] for d in done) == 15
    assert sum(r["rows"] for r in L.error_log(spark, state).collect()) == 15
    again = L.score_exactly_once(stream(), score, state)  # nothing new arrived
    assert again.count() == 40


def test_the_gate_and_strict_mode_stop_before_scoring(spark, tmp_path):
    files(spark, tmp_path, 2)
    stream = lambda: L.file_stream(spark, f"{tmp_path}/in*", "id bigint, v double")
    with pytest.raises(Exception, match="does not pass"):
        L.score_exactly_once(stream(), lambda b: b, f"{tmp_path}/s1", gate=lambda b: ("fail", ["leak"]))
    assert L.finished_batches(spark, f"{tmp_path}/s1").count() == 0
    with pytest.raises(Exception, match="has issues"):
        L.score_exactly_once(stream(), lambda b: b, f"{tmp_path}/s2", {"odd": F.expr("v % 2 = 1")}, "strict")
    assert L.finished_batches(spark, f"{tmp_path}/s2").count() == 0
    kept = L.score_exactly_once(stream(), lambda b: b, f"{tmp_path}/s3", {"odd": F.expr("v % 2 = 1")}, "drop")
    assert kept.count() == 10 and L.error_log(spark, f"{tmp_path}/s3").count() == 2


def test_classification_report_of_missing_classes(spark):
    from quarry.operators.evaluate import classification_report
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "b"), (None, "a")], "y_true string, y_pred string")
    got = {r.label: tuple(r)[1:] for r in classification_report(df).collect()}
    assert got["a"] == (1.0, 0.5, 2 / 3, 2) and got["b"] == (0.0, 0.0, 0.0, 0) and got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["accuracy"][0] == 1 / 3 and math.isclose(got["weighted avg"][0], 2 / 3)
