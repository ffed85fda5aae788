"""Model fitting through MLlib (G1-G17). The reference's scikit-learn estimators
map to MLlib estimators with parameters chosen so the objectives coincide."""

from __future__ import annotations

from typing import Sequence

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


#: Rows of a task of an iterative fit: what a task keeps of them between the passes stays a small part of an executor.
FIT_ROWS = 500_000


def training_input(df: DataFrame, features: Sequence[str], label: str, extra: Sequence[str] = ()) -> DataFrame:
    """Iterative fitters pass over their input many times: the projected training
    rows are written once (into spark.checkpoint.dir) so each pass reads them instead
    of recomputing joins, splits and ranks, and a lost executor does not replay that
    lineage. Packed files make few tasks of many rows; those are dealt out again."""
    from quarry.functions.ranking import spread
    from quarry.session import stored
    cols = list(dict.fromkeys([*features, label, *extra]))
    rows = stored(df.select(*cols))
    return assemble(spread(rows, -(-rows.count() // FIT_ROWS)), features)


def fit_linear(train: DataFrame, features: Sequence[str], label: str, kind: str = "ols", alpha: float = 1.0,
               l1_ratio: float = 0.5):
    """ols / ridge / lasso / elasticnet with the reference's objective scaling."""
    data = training_input(train, features, label)
    if kind == "ols":
        est = LinearRegression(regParam=0.0, solver="normal")
    elif kind == "ridge":
        sd = train.agg(F.stddev_pop(label)).first()[0] or 1.0
        n = train.count()
        est = LinearRegression(regParam=alpha * sd / n, elasticNetParam=0.0, standardization=False, solver="normal")
    elif kind == "lasso":
        est = LinearRegression(regParam=alpha, elasticNetParam=1.0, standardization=False)
    elif kind == "elasticnet":
        sd = train.agg(F.stddev_pop(label)).first()[0] or 1.0
        l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio) * sd
        est = LinearRegression(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2), standardization=False)
    else:
        raise ValueError(kind)
    return est.setLabelCol(label).setFeaturesCol("features").fit(data)


def fit_logistic(train: DataFrame, features: Sequence[str], label: str, C: float = 1.0, weight_col: str | None = None):
    n = train.count()
    est = LogisticRegression(regParam=1.0 / (C * n), elasticNetParam=0.0, standardization=False, labelCol=label)
    if weight_col:
        est = est.setWeightCol(weight_col)
    return est.fit(training_input(train, features, label, [weight_col] if weight_col else []))


def coefficients(model, features: Sequence[str], spark) -> DataFrame:
    """Coefficient table (feature, coefficient, importance = |coefficient|), sorted by importance."""
    coefs = [float(c) for c in model.coefficients]
    rows = [(f, c, abs(c)) for f, c in zip(features, coefs)] + [("__intercept__", float(model.intercept), None)]
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double")


def class_weights(df: DataFrame, label: str, given: dict | Sequence[float] | None = None) -> DataFrame:
    """Weight per class: balanced n / (k * n_c), or ``given`` by class (a class without one has 1) or as a list
    in the classes' sorted order."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    if given is None:
        n = df.count()
        k = counts.count()
        return counts.select(label, "n_c", (F.lit(float(n)) / (F.lit(float(k)) * F.col("n_c"))).alias("weight"))
    if isinstance(given, dict):
        weight = F.lit(1.0)
        for c, w in given.items():
            weight = F.when(F.col(label).cast("string") == str(c), F.lit(float(w))).otherwise(weight)
        return counts.select(label, "n_c", weight.alias("weight"))
    from pyspark.sql import Window
    if counts.count() != len(given):
        raise ValueError(f"{len(given)} weights for {counts.count()} classes")
    place = F.row_number().over(Window.orderBy(label))  # one row per class
    return counts.select(label, "n_c", F.element_at(F.array(*[F.lit(float(w)) for w in given]), place).alias("weight"))


def oversample(df: DataFrame, label: str, row_id: str, seed: int = 0) -> DataFrame:
    """Replicate each class up to the majority size (whole copies + md5-ranked remainder). Rows without a
    label are a class of their own."""
    from quarry.functions.hashing import hash_unit
    from quarry.functions.ranking import bounded_broadcast, join_null_safe, rank_within_groups
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    mx = counts.agg(F.max("_n")).scalar()
    ranked = rank_within_groups(df.withColumn("_h", hash_unit(seed, row_id)), [label], ["_h", row_id], "_r")
    j = join_null_safe(ranked, bounded_broadcast(counts), [label])
    copies = F.floor(mx / F.col("_n")) + F.when(F.col("_r") < F.pmod(mx, F.col("_n")), 1).otherwise(0)
    return j.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int")))).drop("_h", "_r", "_n")


def undersample(df: DataFrame, label: str, row_id: str, seed: int = 0) -> DataFrame:
    """Keep min-class-size rows per class (md5 order). Rows without a label are a class of their own."""
    from quarry.functions.hashing import hash_unit
    from quarry.functions.ranking import rank_within_groups
    mn = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).agg(F.min("_n")).scalar()
    ranked = rank_within_groups(df.withColumn("_h", hash_unit(seed, row_id)), [label], ["_h", row_id], "_r")
    return ranked.where(F.col("_r") < mn).drop("_h", "_r")


# ------------------------------------------------------------------ Gram-matrix linear models
def gram_centre(df: DataFrame, features: Sequence[str], label: str) -> list[float]:
    """Means of the features and the label (one row). Gram sums are taken around them: raw
    sums of products lose all digits of a feature whose mean is large against its spread."""
    return [v or 0.0 for v in df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate([*features, label])]).first()]


def gram_by(df: DataFrame, features: Sequence[str], label: str, key: str | None = None, centre: Sequence[float] | None = None):
    """One aggregate pass: n, sum x, sum y, sum y^2, X'X and X'y (optionally per key,
    e.g. per fold) of the columns less ``centre`` (default 0; see :func:`gram_centre`).
    Returns {key: dict of numpy arrays}; the result is d x d per key. Grams that are
    used together must share a centre."""
    import numpy as np
    centre = list(centre) if centre is not None else [0.0] * (len(features) + 1)
    xs = [F.col(f"`{f}`").cast("double") - F.lit(float(c)) for f, c in zip(features, centre)]
    y = F.col(f"`{label}`").cast("double") - F.lit(float(centre[-1]))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    aggs += [F.sum(x).alias(f"sx{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(x * y).alias(f"sxy{i}") for i, x in enumerate(xs)]
    aggs += [F.sum(xs[i] * xs[j]).alias(f"sxx{i}_{j}") for i in range(len(xs)) for j in range(i, len(xs))]
    rows = (df.groupBy(key).agg(*aggs) if key else df.agg(*aggs)).collect()  # one row per key: schema-sized
    d = len(features)
    out = {}
    for r in rows:
        xx = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                xx[i, j] = xx[j, i] = r[f"sxx{i}_{j}"]
        out[r[key] if key else None] = {"n": float(r["n"]), "sy": r["sy"], "syy": r["syy"],
                                       "sx": np.array([r[f"sx{i}"] for i in range(d)]),
                                       "sxy": np.array([r[f"sxy{i}"] for i in range(d)]), "xx": xx}
    return out


def _sub(a, b):
    return {k: a[k] - b[k] for k in a}


def solve_ridge(g, alpha: float):
    """Intercept-unpenalised ridge from Gram sums (alpha = 0 gives OLS); the intercept
    belongs to the columns less the Gram's centre."""
    import numpy as np
    n = g["n"]
    mu, my = g["sx"] / n, g["sy"] / n
    sxx = g["xx"] - n * np.outer(mu, mu)
    sxy = g["sxy"] - n * mu * my
    w = np.linalg.solve(sxx + alpha * np.eye(len(mu)), sxy)
    return w, my - mu @ w


def solve_elasticnet(g, l1: float, l2: float, tol: float = 1e-12, max_iter: int = 100_000):
    """min 1/(2n) |y - Xw - b|^2 + l1 |w|_1 + l2/2 |w|^2 by coordinate descent on Gram sums (no further pass
    over the rows); the intercept is not penalised."""
    import numpy as np
    n = g["n"]
    mu, my = g["sx"] / n, g["sy"] / n
    a, c = g["xx"] / n - np.outer(mu, mu), g["sxy"] / n - mu * my
    w = np.zeros(len(mu))
    for _ in range(max_iter):
        moved = 0.0
        for j in range(len(w)):
            rho = c[j] - a[j] @ w + a[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / (a[j, j] + l2) if a[j, j] + l2 > 0 else 0.0
            moved = max(moved, abs(new - w[j]))
            w[j] = new
        if moved <= tol * max(1.0, float(np.abs(w).max())):
            break
    return w, my - mu @ w


def fit_linear_gram(train: DataFrame, features: Sequence[str], label: str, kind: str = "ols", alpha: float = 1.0,
                    l1_ratio: float = 0.5):
    """(w, b) of ols / ridge / lasso / elasticnet from one aggregate pass. Objectives: |y - Xw - b|^2 + alpha |w|^2 for
    ridge; 1/(2n) |y - Xw - b|^2 + alpha (l1_ratio |w|_1 + (1 - l1_ratio)/2 |w|^2) for the last two (l1_ratio 1 for
    lasso). Collinear columns (a full one-hot) get the shortest w of ols."""
    import numpy as np
    centre = gram_centre(train, features, label)
    g = gram_by(train, features, label, centre=centre)[None]
    if kind == "ols":
        n = g["n"]
        mu, my = g["sx"] / n, g["sy"] / n
        w = np.linalg.pinv(g["xx"] - n * np.outer(mu, mu), rcond=1e-12, hermitian=True) @ (g["sxy"] - n * mu * my)
        b = my - mu @ w
    elif kind == "ridge":
        w, b = solve_ridge(g, alpha)
    elif kind in ("lasso", "elasticnet"):
        share = 1.0 if kind == "lasso" else l1_ratio
        w, b = solve_elasticnet(g, alpha * share, alpha * (1 - share))
    else:
        raise ValueError(f"unknown linear model '{kind}'")
    return w, float(b + centre[-1] - sum(x * c for x, c in zip(w, centre)))


# ------------------------------------------------------------------ G5 / H15: Newton fits by aggregated Hessians
def newton_logistic(df: DataFrame, features: Sequence[str], label: str, n_classes: int = 2, l2: float = 0.0,
                    weight_col: str | None = None, fold_col: str | None = None, folds: int = 0, max_iter: int = 50, tol: float = 1e-10):
    """Logistic models by iteratively reweighted least squares: {model: array of (class, intercept + features)}.

    Objective: sum of (weighted) log-losses + l2/2 |w|^2, intercepts free. Two classes have one row of
    coefficients (class 1 against 0), more have one per class (softmax). ``label`` holds class numbers 0..n-1; rows
    with a null label or feature take no part. With ``fold_col``, model k in 0..folds-1 is fitted on the rows of all
    other folds. Each step is one aggregate of loss, gradient and Hessian for all models and classes at
    once: a task adds up matrix products of its batches, and only the sums (parameters squared, per model) are shuffled
    and reach the driver. A step that raises the loss is halved. Directions without curvature (collinear columns) are
    left where they are."""
    import numpy as np
    import pyarrow as pa

    from quarry.session import stored
    d, blocks, models = len(features) + 1, 1 if n_classes == 2 else n_classes, folds if fold_col else 1
    names = [f"x{i}" for i in range(1, d)]
    rows = df.select(*[F.col(f"`{f}`").cast("double").alias(x) for f, x in zip(features, names)], F.col(label).cast("int").alias("y"),
                     (F.col(weight_col).cast("double") if weight_col else F.lit(1.0)).alias("w"),
                     (F.col(fold_col).cast("int") if fold_col else F.lit(-1)).alias("f")).dropna()
    rows = stored(rows)  # read once a step
    params, folded = blocks * d, fold_col is not None
    upper = np.triu_indices(params)
    penalty = np.tile(np.r_[0.0, np.full(d - 1, float(l2))], blocks)

    def sums(beta: np.ndarray) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
        def add(batches):
            """Per model of a task: loss, gradient and the Hessian's upper half, one after the other."""
            total = {}
            for batch in batches:
                cols = [batch.column(i).to_numpy() for i in range(d + 2)]
                every, ys, ws, fs = np.column_stack([np.ones(batch.num_rows), *cols[:d - 1]]), cols[d - 1], cols[d], cols[d + 1]
                for m in range(models):
                    mine = fs != m if folded else slice(None)
                    x, y, w = every[mine], ys[mine], ws[mine]
                    if not len(x):
                        continue
                    z = x @ beta[m].reshape(blocks, d).T
                    if blocks == 1:  # stable log(1 + e^z)
                        small = np.exp(-np.abs(z))
                        p, hit = np.where(z >= 0, 1 / (1 + small), small / (1 + small)), (y == 1).astype(float)[:, None]
                        loss = np.maximum(z[:, 0], 0) + np.log1p(small[:, 0]) - hit[:, 0] * z[:, 0]
                    else:
                        top = z.max(axis=1, keepdims=True)
                        e = np.exp(z - top)
                        s = e.sum(axis=1, keepdims=True)
                        p, hit = e / s, (y[:, None] == np.arange(blocks)).astype(float)
                        loss = top[:, 0] + np.log(s[:, 0]) - (hit * z).sum(axis=1)
                    grad = ((p - hit) * w[:, None]).T @ x
                    hess = np.zeros((blocks, d, blocks, d))
                    for a in range(blocks):
                        for b in range(a, blocks):
                            hess[a, :, b, :] = x.T @ (x * (w * p[:, a] * ((a == b) - p[:, b]))[:, None])
                    one = np.concatenate([[w @ loss], grad.ravel(), hess.reshape(params, params)[upper]])
                    total[m] = total[m] + one if m in total else one
            if total:
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))], names=["m", "v"])

        out = {m: np.zeros(1 + params + len(upper[0])) for m in range(models)}
        parts = rows.select(*names, "y", "w", "f").mapInArrow(add, "m int, v array<double>").select("m", F.posexplode("v").alias("at", "v"))
        got = parts.groupBy("m", "at").agg(F.sum("v").alias("v")).toArrow()  # parameters squared, per model
        m_, at, v = (got.column(c).to_numpy() for c in ("m", "at", "v"))
        seen = set(m_.tolist())
        for m in seen:
            out[m][at[m_ == m]] = v[m_ == m]
        done_ = {}
        for m in sorted(seen):
            hess = np.zeros((params, params))
            hess[upper] = out[m][1 + params:]
            hess = np.triu(hess) + np.triu(hess, 1).T
            bm = beta[m]
            done_[m] = (out[m][0] + 0.5 * float(penalty @ (bm * bm)), out[m][1:1 + params] + penalty * bm, hess + np.diag(penalty))
        return done_

    beta, step, best = np.zeros((models, params)), np.zeros((models, params)), {}
    done = set()
    for _ in range(max_iter):
        now = sums(beta)
        for m, (loss, grad, hess) in now.items():
            if m in done:
                continue
            if m in best and loss > best[m][0] * (1 + 1e-12) + 1e-12:
                step[m] /= 2
                beta[m] = best[m][1] + step[m]
                continue
            best[m] = (loss, beta[m].copy())
            step[m] = -np.linalg.pinv(hess, rcond=1e-12, hermitian=True) @ grad
            beta[m] = best[m][1] + step[m]
            if np.abs(step[m]).max() <= tol * max(1.0, np.abs(beta[m]).max()):
                done.add(m)
        if len(done) == len(now):
            break
    return {m: beta[m].reshape(blocks, d) for m in best}


def logistic_proba(coef, features: Sequence[str]) -> list:
    """Probability columns of classes 0..n-1 from :func:`newton_logistic`'s coefficients of one model."""
    z = []
    for row in coef:
        e = F.lit(float(row[0]))
        for f, v in zip(features, row[1:]):
            e = e + F.lit(float(v)) * F.col(f"`{f}`")
        z.append(e)
    if len(z) == 1:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z[0]))
        return [F.lit(1.0) - p, p]
    top = F.greatest(*z)
    total = sum((F.exp(v - top) for v in z), F.lit(0.0))
    return [F.exp(v - top) / total for v in z]


def cross_validate_logistic(df: DataFrame, folds: DataFrame, row_id: str, features: Sequence[str], label: str, k: int,
                            l2: float = 1.0) -> DataFrame:
    """H21 for binary logistic models: all fold fits in the same Newton steps; held-out accuracy and log-loss per
    fold, then mean (fold -1) and population deviation (fold -2)."""
    from quarry.operators.evaluate import EPS
    data = df.join(folds, row_id)
    fits = newton_logistic(data, features, label, 2, l2, fold_col="fold", folds=k)
    p = F.lit(None).cast("double")
    for m, coef in fits.items():
        p = F.when(F.col("fold") == m, logistic_proba(coef, features)[1]).otherwise(p)
    y = F.col(label)
    pc = F.least(F.greatest(F.col("_p"), F.lit(EPS)), F.lit(1 - EPS))
    per = data.withColumn("_p", p).groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg(((F.col("_p") >= 0.5).cast("int") == y).cast("double")).alias("accuracy"),
        (-F.avg(F.when(y == 1, F.ln(pc)).otherwise(F.ln(1 - pc)))).alias("log_loss")).select(F.col("fold").cast("bigint"), "n", "accuracy", "log_loss")
    none = F.lit(None).cast("bigint").alias("n")
    mean = per.agg(F.avg("accuracy").alias("accuracy"), F.avg("log_loss").alias("log_loss")).select(F.lit(-1).cast("bigint").alias("fold"), none, "accuracy", "log_loss")
    std = per.agg(F.stddev_pop("accuracy").alias("accuracy"), F.stddev_pop("log_loss").alias("log_loss")).select(F.lit(-2).cast("bigint").alias("fold"), none, "accuracy", "log_loss")
    return per.unionByName(mean).unionByName(std)


def sse_from_gram(g, w, b) -> float:
    return float(g["syy"] + g["n"] * b * b + w @ g["xx"] @ w - 2 * b * g["sy"] - 2 * w @ g["sxy"] + 2 * b * (w @ g["sx"]))


def cross_validate_linear(df: DataFrame, folds: DataFrame, row_id: str, features: Sequence[str], label: str,
                          alpha: float = 0.0) -> DataFrame:
    """H21 for OLS / ridge: per-fold fits from (total - fold) Gram sums and held-out
    RMSE / R2 from the fold's own sums, all from one aggregate pass.
    Output: (fold, n, rmse, r2) plus mean / population-std rows."""
    import numpy as np
    grams = gram_by(df.join(folds, row_id), features, label, "fold", gram_centre(df, features, label))
    total = None
    for g in grams.values():
        total = g if total is None else {k: total[k] + g[k] for k in g}
    rows = []
    for f in sorted(grams):
        g = grams[f]
        w, b = solve_ridge(_sub(total, g), alpha)
        sse = sse_from_gram(g, w, b)
        sst = g["syy"] - g["sy"] ** 2 / g["n"]
        rows.append((int(f), int(g["n"]), float(np.sqrt(sse / g["n"])), float(1 - sse / sst) if sst > 0 else 0.0))
    rm = np.array([r[2] for r in rows]); r2 = np.array([r[3] for r in rows])
    rows += [(-1, None, float(rm.mean()), float(r2.mean())), (-2, None, float(rm.std()), float(r2.std()))]
    return df.sparkSession.createDataFrame(rows, "fold bigint, n bigint, rmse double, r2 double")


def grid_search_ridge(train: DataFrame, val: DataFrame, features: Sequence[str], label: str,
                      alphas: Sequence[float]) -> DataFrame:
    """G16 for ridge: every alpha solved from one train Gram and scored from one
    validation Gram -> (trial_id, alpha, rmse, r2, best)."""
    import numpy as np
    centre = gram_centre(train, features, label)
    gt, gv = gram_by(train, features, label, centre=centre)[None], gram_by(val, features, label, centre=centre)[None]
    sst = gv["syy"] - gv["sy"] ** 2 / gv["n"]
    rows = []
    for i, a in enumerate(alphas):
        w, b = solve_ridge(gt, float(a))
        sse = sse_from_gram(gv, w, b)
        rows.append((i, float(a), float(np.sqrt(sse / gv["n"])), float(1 - sse / sst) if sst > 0 else 0.0))
    best = min(rows, key=lambda r: (r[2], r[0]))[0]
    return train.sparkSession.createDataFrame([r + (r[0] == best,) for r in rows],
                                              "trial_id bigint, alpha double, rmse double, r2 double, best boolean")


def fit_ridge_classifier(train: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0):
    """G6 (binary): ridge on a +-1 target; the class is the sign. Returns (w, b)."""
    t = train.withColumn("_pm", F.when(F.col(label) == 1, 1.0).otherwise(-1.0))
    centre = gram_centre(t, features, "_pm")
    w, b = solve_ridge(gram_by(t, features, "_pm", centre=centre)[None], alpha)
    return w, b + centre[-1] - sum(x * c for x, c in zip(w, centre))


# ------------------------------------------------------------------ H15 / H16
def calibrate_sigmoid(val: DataFrame, score: str, label: str) -> tuple[float, float]:
    """Platt scaling: (intercept, slope) of the unregularised logistic model on the score, by Newton steps."""
    coef = newton_logistic(val, [score], label)[0][0]
    return float(coef[0]), float(coef[1])


def apply_sigmoid(df: DataFrame, fitted: tuple[float, float], score: str) -> DataFrame:
    return df.withColumn("p_cal", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(fitted[0]) + F.lit(fitted[1]) * F.col(score)))))


def calibrate_isotonic(val: DataFrame, score: str, label: str):
    from pyspark.ml.regression import IsotonicRegression
    return IsotonicRegression(labelCol=label, featuresCol="features").fit(training_input(val, [score], label))


def apply_calibration(model, df: DataFrame, score: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    out = model.transform(assemble(df, [score]))
    if "probability" in out.columns:
        return out.withColumn("p_cal", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
    return out.withColumnRenamed("prediction", "p_cal").drop("features")


# ------------------------------------------------------------------ G7-G11, G17
def fit_classifier(train: DataFrame, features: Sequence[str], label: str, kind: str, seed: int = 42, n_classes: int = 2):
    """MLlib classifiers with the reference's settings: random_forest (100 trees,
    depth 8, leaf 2), gradient_boosting (100 rounds, lr 0.1, depth 3; binary),
    mlp (one hidden layer of 64), linear_svc."""
    from pyspark.ml.classification import GBTClassifier, LinearSVC, MultilayerPerceptronClassifier
    data = training_input(train, features, label)
    if kind == "random_forest":
        est = RandomForestClassifier(numTrees=100, maxDepth=8, minInstancesPerNode=2, seed=seed)
    elif kind == "gradient_boosting":
        est = GBTClassifier(maxIter=100, stepSize=0.1, maxDepth=3, seed=seed)
    elif kind == "mlp":
        est = MultilayerPerceptronClassifier(layers=[len(features), 64, n_classes], seed=seed, maxIter=200)
    elif kind == "linear_svc":
        est = LinearSVC(regParam=1.0 / train.count())
    else:
        raise ValueError(f"model '{kind}' has no distributed implementation here")
    return est.setLabelCol(label).setFeaturesCol("features").fit(data)


def fit_mllib(train: DataFrame, features: Sequence[str], label: str, kind: str, task: str, n_classes: int = 2, seed: int = 42,
              params: dict | None = None, weight_col: str | None = None):
    """MLlib estimators by name and task, with the settings of :func:`fit_classifier`; ``params`` overrides them
    by MLlib's parameter names. Regression: random_forest, gradient_boosting; classification also logistic, mlp."""
    from pyspark.ml import classification as C
    from pyspark.ml import regression as R
    forest, boost = dict(numTrees=100, maxDepth=8, minInstancesPerNode=2, seed=seed), dict(maxIter=100, stepSize=0.1, maxDepth=3, seed=seed)
    if task == "regression":
        known = {"random_forest": (R.RandomForestRegressor, forest), "gradient_boosting": (R.GBTRegressor, boost)}
    else:
        known = {"random_forest": (C.RandomForestClassifier, forest), "gradient_boosting": (C.GBTClassifier, boost),
                 "mlp": (C.MultilayerPerceptronClassifier, dict(layers=[len(features), 64, n_classes], seed=seed, maxIter=200)),
                 "logistic": (C.LogisticRegression, dict(regParam=1.0 / max(1, train.count()), standardization=False, maxIter=200, tol=1e-9))}
    if kind not in known:
        raise ValueError(f"model '{kind}' is not one for {task}")
    if kind == "gradient_boosting" and task == "classification" and n_classes != 2:
        raise ValueError("gradient boosting has two classes here")
    make, settings = known[kind]
    est = make(**(settings | dict(params or {}))).setLabelCol(label).setFeaturesCol("features")
    if weight_col:
        est = est.setWeightCol(weight_col)
    elif make is R.GBTRegressor and _fits_on_cells(est):
        return fit_boosted_cells(train, features, label, est)
    return est.fit(training_input(train, features, label, [weight_col] if weight_col else []))


# ------------------------------------------------------------------ G8: boosting by cells of equal bins
def _fits_on_cells(est) -> bool:
    """Whether the trees depend on the rows of a cell through their number and mean alone: squared loss, no row is
    left out and none counted for itself."""
    get = est.getOrDefault
    return (get("lossType") == "squared" and get("subsamplingRate") == 1.0 and get("minInstancesPerNode") == 1
            and not est.isSet("validationIndicatorCol"))


def split_candidates(values, share: float, n: int, max_splits: int) -> list[float]:
    """MLlib's candidate thresholds of one feature: between all neighbours of the sampled ``values`` if there are few,
    else about equally many rows apart. ``share`` of ``n`` rows was sampled; rows missing from that number count as 0."""
    import numpy as np
    some = values[values != 0.0]
    if not len(some):
        return []
    v, c = np.unique(some, return_counts=True)
    zeros = share * n - len(some)
    if zeros > np.finfo(float).eps * len(some) * 100:
        at = int(np.searchsorted(v, 0.0))
        v, c = np.insert(v, at, 0.0), np.insert(c.astype(float), at, zeros)
    middle = (v[:-1] + v[1:]) / 2
    if len(middle) <= max_splits:
        return middle.tolist()
    stride = share * n / (max_splits + 1)
    out, target, count = [], stride, float(c[0])
    for m, k in zip(middle, c[1:]):
        before, count = count, count + float(k)
        if abs(before - target) < abs(count - target):
            out.append(float(m))
            target += stride
    return out


def fit_boosted_cells(train: DataFrame, features: Sequence[str], label: str, est):
    """``est`` (a GBTRegressor for which :func:`_fits_on_cells`) fitted in three passes over the rows, however many
    rounds it has. MLlib sees a feature only through its bins, so rows of equal bins, a cell, share every node and every
    residual's offset: the gain of a split, the leaves and the residuals follow from each cell's number of rows and mean
    label. There are at most maxBins to the power of the features' number, and never more than rows. The candidate
    thresholds are MLlib's, from the rows it would sample; the trees are MLlib's, on the cells with bin numbers for
    features, whose thresholds are then put back. Impurities of the nodes leave out the spread within cells. Rows that
    MLlib refuses are given to it."""
    from math import isqrt

    from pyspark.ml.regression import GBTRegressor

    from quarry.functions.ranking import spread
    from quarry.session import stored
    spark, max_bins = train.sparkSession, est.getMaxBins()
    rows = stored(train.select(*dict.fromkeys([*features, label])))
    n, jvm = rows.count(), spark._jvm
    whole = lambda rows: assemble(spread(rows, -(-rows.count() // FIT_ROWS)), features)
    if not n:
        return est.fit(whole(rows))

    share = min(1.0, max(max_bins * max_bins, 10_000) / n)
    xs = rows.select(*[F.col(f).cast("double") for f in features])
    if share < 1:
        seed = jvm.org.apache.spark.util.random.XORShiftRandom(est.getSeed()).nextInt()
        xs = DataFrame(spark._jsparkSession.createDataFrame(xs._jdf.rdd().sample(False, share, seed).toJavaRDD(), xs._jdf.schema()), spark)
    sample = xs.toArrow()  # at most about 10 000 rows, or maxBins squared
    cuts = [split_candidates(sample.column(i).drop_null().to_numpy(), share, n, min(max_bins, n) - 1) for i in range(len(features))]

    def bin_of(f: str, ends: list[float]):
        """One more than the number of thresholds below the value."""
        x, out = F.col(f).cast("double"), F
        for i, c in enumerate(ends):
            out = out.when(x <= F.lit(c), F.lit(i + 1))  # NaN is above all, but refused below
        return out.otherwise(F.lit(len(ends) + 1)) if ends else F.lit(1)

    odd = F.lit(False)
    for c in (*features, label):
        x = F.col(c).cast("double")
        odd = odd | x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    bins = [f"_b{i}" for i in range(len(features))]
    y = F.col(label).cast("double")
    cells = stored(rows.select(y.alias("_y"), odd.alias("_odd"), *[bin_of(f, c).alias(b) for f, c, b in zip(features, cuts, bins)])
                   .groupBy(*bins).agg(F.count(F.lit(1)).cast("double").alias("_w"), F.avg("_y").alias("_y"), F.max("_odd").alias("_odd")))
    if cells.where("_odd").limit(1).count():
        return est.fit(whole(rows))
    many = cells.count()
    on_cells = est.copy().setLabelCol("_y").setWeightCol("_w").setMaxBins(max(max_bins, isqrt(many) + 1))  # so many that every bin is sampled
    fitted = on_cells.fit(assemble(spread(cells, -(-many // FIT_ROWS)), bins))

    ml, gateway = jvm.org.apache.spark.ml, spark.sparkContext._gateway

    def unbinned(node):
        if not node.subtreeDepth():
            return node
        at = node.split()
        cut = cuts[at.featureIndex()][int(at.threshold()) - 1]
        return ml.tree.InternalNode(node.prediction(), node.impurity(), node.gain(), unbinned(node.leftChild()), unbinned(node.rightChild()),
                                    ml.tree.ContinuousSplit(at.featureIndex(), cut), node.impurityStats())

    old, weights = fitted._java_obj.trees(), fitted.treeWeights
    trees, shares = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(old)), gateway.new_array(jvm.double, len(old))
    for i, tree in enumerate(old):
        trees[i], shares[i] = ml.regression.DecisionTreeRegressionModel(tree.uid(), unbinned(tree.rootNode()), len(features)), float(weights[i])
    return est._copyValues(est._create_model(ml.regression.GBTRegressionModel(est.uid, trees, shares, len(features))))


def feature_importance(model, features: Sequence[str], spark) -> DataFrame:
    """Tree importances (or |coefficient|), sorted descending."""
    if hasattr(model, "featureImportances"):
        vals = [float(v) for v in model.featureImportances.toArray()]
    else:
        vals = [abs(float(v)) for v in model.coefficients]
    rows = sorted(zip(features, vals), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "feature string, importance double")


def pos_weight(df: DataFrame, label: str, given: float | None = None) -> DataFrame:
    """n_neg / n_pos for a binary label, or a given positive value."""
    if given is not None:
        if given <= 0:
            raise ValueError("pos_weight must be > 0")
        return df.sparkSession.createDataFrame([(float(given),)], "pos_weight double")
    return df.agg(F.try_divide(F.count_if(F.col(label) != 1).cast("double"), F.count_if(F.col(label) == 1).cast("double")).alias("pos_weight"))
