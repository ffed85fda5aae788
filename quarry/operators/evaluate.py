"""Evaluation of prediction tables.

Input: a prediction table with ``y_true``, ``y_pred`` and, for classifiers, a
positive-class score or a ``proba`` array (class index order). Every metric is
one aggregate with map-side partial aggregation. Curve metrics (ROC AUC,
average precision, ROC curve) first collapse rows to one row per distinct score
and then take running sums with the range-partitioned cumulative-sum helper,
never an unpartitioned window. Bootstrap draws are made in the tasks of ``spark.range``
and meet a dense row index block by block, so the fan-out is spread over all tasks."""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit
from quarry.functions.ranking import (bounded_broadcast, exact_quantiles, first_index_above, global_cumsum,
                                      join_null_safe, spread)
from quarry.operators.resample import draw_sums, poisson_sums

# Machine epsilon for float64 (log-loss clipping) and the default
# threshold grid 0.05, 0.10, ..., 0.95 (i/100 for i = 5, 10, ..., 95).
EPS = 2.220446049250313e-16
THRESHOLD_GRID = [i / 100 for i in range(5, 100, 5)]

# Optimisation direction per metric.
MAXIMIZE = {"r2", "accuracy", "f1", "f1_macro", "f1_micro", "f1_weighted", "fbeta", "balanced_accuracy",
            "roc_auc", "pr_auc", "precision", "recall"}


def direction(metric: str) -> str:
    return "maximize" if metric in MAXIMIZE else "minimize"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ H1 / H2
def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """n, mse, rmse, mae, r2 (SST = 0 -> 1 if SSE = 0 else 0) in one pass."""
    e = _c(y) - _c(p)
    a = df.agg(F.count(F.lit(1)).alias("n"), F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
               F.sum(e * e).alias("_sse"), (F.var_pop(_c(y)) * F.count(F.lit(1))).alias("_sst"))
    r2 = F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        F.lit(1.0) - F.col("_sse") / F.col("_sst"))
    return a.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


# ------------------------------------------------------------------ per-class counts
def class_counts(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Per class (union of true and predicted labels): tp, fp, fn, support."""
    hit = (_c(y) == _c(p)).cast("bigint")
    miss = (_c(y) != _c(p)).cast("bigint")
    rows = df.select(F.explode(F.array(
        F.struct(_c(y).alias("cls"), hit.alias("tp"), F.lit(0).cast("bigint").alias("fp"), miss.alias("fn"), F.lit(1).cast("bigint").alias("sup")),
        F.struct(_c(p).alias("cls"), F.lit(0).cast("bigint").alias("tp"), miss.alias("fp"), F.lit(0).cast("bigint").alias("fn"), F.lit(0).cast("bigint").alias("sup")),
    )).alias("s")).select("s.*")
    return rows.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
                                   F.sum("sup").alias("support"))


def _fbeta(tp, fp, fn, beta: float) -> Column:
    b2 = beta * beta
    num = (1 + b2) * tp
    den = (1 + b2) * tp + b2 * fn + fp
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


# ------------------------------------------------------------------ H3 / H4 / H5 / H6
def classification_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred", beta: float = 1.0,
                           pos_label=1) -> DataFrame:
    """accuracy, balanced_accuracy, f-beta binary/macro/micro/weighted (beta=1 -> F1).
    Zero division -> 0; balanced accuracy averages recall over classes present in y_true."""
    cc = class_counts(df, y, p).withColumn("_f", _fbeta(F.col("tp"), F.col("fp"), F.col("fn"), beta))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support"))
    return cc.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(rec).alias("balanced_accuracy"),
        F.max(F.when(F.col("cls") == F.lit(pos_label), F.col("_f"))).alias("f_binary"),
        F.avg("_f").alias("f_macro"),
        _fbeta(F.sum("tp"), F.sum("fp"), F.sum("fn"), beta).alias("f_micro"),
        (F.sum(F.col("_f") * F.col("support")) / F.sum("support")).alias("f_weighted"),
    )


# ------------------------------------------------------------------ H7
def roc_auc(df: DataFrame, y: str = "y_true", score: str = "p", pos_label=1) -> DataFrame:
    """Binary ROC AUC with half credit for ties (= Mann-Whitney U / (P*N))."""
    per = df.groupBy(_c(score).alias("_s")).agg(
        F.sum((_c(y) == pos_label).cast("bigint")).alias("pos"), F.sum((_c(y) != pos_label).cast("bigint")).alias("neg"))
    cum = global_cumsum(per, ["_s"], ["neg"], suffix="_below", inclusive=False)
    return cum.agg(F.try_divide(F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.lit(0.5) * F.col("neg"))),
                                F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("roc_auc"))


def _desc_curve(df: DataFrame, y: str, score: str, pos_label) -> DataFrame:
    per = df.groupBy(_c(score).alias("_s")).agg(
        F.sum((_c(y) == pos_label).cast("bigint")).alias("pos"), F.sum((_c(y) != pos_label).cast("bigint")).alias("neg"))
    return global_cumsum(per, [F.col("_s").desc()], ["pos", "neg"], suffix="_cum", inclusive=True)


# ------------------------------------------------------------------ H8
def average_precision(df: DataFrame, y: str = "y_true", score: str = "p", pos_label=1) -> DataFrame:
    """sum over thresholds (R_i - R_{i-1}) * P_i, thresholds = distinct scores descending."""
    cur = _desc_curve(df, y, score, pos_label)
    prec = F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))
    return cur.agg(F.try_divide(F.sum(F.col("pos") * prec), F.sum("pos").cast("double")).alias("pr_auc"))


# ------------------------------------------------------------------ H18
def roc_curve(df: DataFrame, y: str = "y_true", score: str = "p", pos_label=1) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the (inf, 0, 0) start point.
    All points are kept (no intermediate dropping)."""
    cur = _desc_curve(df, y, score, pos_label)
    P = cur.agg(F.sum("pos").cast("double")).scalar()  # scalar subquery, evaluated once
    N = cur.agg(F.sum("neg").cast("double")).scalar()
    pts = cur.select(F.col("_s").alias("threshold"),
                     F.try_divide(F.col("neg_cum"), N).alias("fpr"),
                     F.try_divide(F.col("pos_cum"), P).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


# ------------------------------------------------------------------ H9
def log_loss_binary(df: DataFrame, y: str = "y_true", p: str = "p") -> DataFrame:
    """Clip [1-p, p] to [eps, 1-eps], row-normalise, mean negative log-likelihood."""
    pc = F.least(F.greatest(_c(p), F.lit(EPS)), F.lit(1 - EPS))
    qc = F.least(F.greatest(F.lit(1.0) - _c(p), F.lit(EPS)), F.lit(1 - EPS))
    s = pc + qc
    ll = F.when(_c(y) == 1, F.ln(pc / s)).otherwise(F.ln(qc / s))
    return df.agg((-F.avg(ll)).alias("log_loss"))


def log_loss_multiclass(df: DataFrame, y: str = "y_true", proba: str = "proba") -> DataFrame:
    clipped = F.transform(_c(proba), lambda v: F.least(F.greatest(v, F.lit(EPS)), F.lit(1 - EPS)))
    s = F.aggregate(clipped, F.lit(0.0), lambda acc, v: acc + v)
    pt = F.element_at(clipped, (_c(y) + 1).cast("int"))
    return df.agg((-F.avg(F.ln(pt / s))).alias("log_loss"))


def positive_proba(proba) -> Column:
    """1-D score passes through; a probability array gives its second entry."""
    c = _c(proba)
    return F.when(F.size(c) >= 2, F.element_at(c, 2)).otherwise(F.element_at(c, 1))


# ------------------------------------------------------------------ H12
def threshold_search(df: DataFrame, y: str = "y_true", score: str = "p", metric: str = "f1",
                     grid: Sequence[float] = THRESHOLD_GRID, beta: float = 1.0) -> DataFrame:
    """Score every threshold t (predict 1 when score >= t); the best is the first
    strict improvement in grid order. One pass: each row is mapped to the number of
    grid thresholds it clears; confusion counts per threshold are suffix sums over
    that (grid-sized) table."""
    g = sorted(set(float(t) for t in grid))
    k = first_index_above(_c(score), g)  # number of grid thresholds <= score
    per = df.groupBy(k.alias("k")).agg(F.sum((_c(y) == 1).cast("bigint")).alias("pos"),
                                       F.sum((_c(y) != 1).cast("bigint")).alias("neg"))
    spark = df.sparkSession
    ks = spark.createDataFrame([(i,) for i in range(len(g) + 1)], "k int")
    full = ks.join(per, "k", "left").fillna(0, ["pos", "neg"])
    wsuf = Window.orderBy(F.col("k").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)  # grid-sized
    wall = Window.partitionBy(F.lit(1))
    full = (full.withColumn("tp", F.sum("pos").over(wsuf)).withColumn("fp", F.sum("neg").over(wsuf))
            .withColumn("P", F.sum("pos").over(wall)).withColumn("N", F.sum("neg").over(wall)))
    thr = spark.createDataFrame([(i + 1, t) for i, t in enumerate(g)], "k int, threshold double")
    t = thr.join(full, "k").withColumn("fn", F.col("P") - F.col("tp")).withColumn("tn", F.col("N") - F.col("fp"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    scores = {
        "f1": _fbeta(tp, fp, fn, 1.0),
        "fbeta": _fbeta(tp, fp, fn, beta),
        "accuracy": (tp + tn) / (tp + fp + fn + tn),
        "precision": F.when(tp + fp == 0, 0.0).otherwise(tp / (tp + fp)),
        "recall": F.when(tp + fn == 0, 0.0).otherwise(tp / (tp + fn)),
        "balanced_accuracy": (F.when(tp + fn > 0, tp / (tp + fn)) + F.when(tn + fp > 0, tn / (tn + fp))) / 2,
    }
    if metric not in scores:
        raise ValueError(f"metric '{metric}' is not supported for threshold search")
    t = t.withColumn("score", scores[metric])
    order = F.col("score").desc() if direction(metric) == "maximize" else F.col("score").asc()
    best = F.row_number().over(Window.orderBy(order, F.col("threshold").asc())) == 1  # grid-sized
    return t.select("threshold", "tp", "fp", "fn", "tn", "score", best.alias("is_best"))


# ------------------------------------------------------------------ H13 / H14
def calibration_inputs(df: DataFrame, y: str = "y_true", score: str | None = "p", proba: str | None = None) -> DataFrame:
    """(confidence, correct): binary -> positive score and y==1; multiclass -> top-1 proba and argmax==y."""
    if proba is None:
        conf, correct = _c(score), (_c(y) == 1).cast("double")
    else:
        conf = F.array_max(_c(proba))
        top = F.array_position(_c(proba), F.array_max(_c(proba))) - 1
        correct = (top == _c(y)).cast("double")
    return df.select(F.least(F.greatest(conf, F.lit(0.0)), F.lit(1.0)).alias("confidence"),
                     F.least(F.greatest(correct, F.lit(0.0)), F.lit(1.0)).alias("correct"))


def calibration_curve(df: DataFrame, y: str = "y_true", score: str | None = "p", proba: str | None = None,
                      n_bins: int = 10) -> DataFrame:
    """Non-empty bins: bin = min(floor(conf * n_bins), n_bins - 1); count, mean confidence, mean accuracy."""
    ci = calibration_inputs(df, y, score, proba)
    b = F.least(F.floor(F.col("confidence") * n_bins), F.lit(n_bins - 1)).cast("bigint")
    return ci.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"),
                                          F.avg("confidence").alias("mean_confidence"),
                                          F.avg("correct").alias("mean_accuracy"))


def calibration_ece(curve: DataFrame) -> DataFrame:
    """sum n_b / n * |acc_b - conf_b| over a calibration curve."""
    return curve.agg((F.sum(F.col("count") * F.abs(F.col("mean_accuracy") - F.col("mean_confidence")))
                      / F.sum("count")).alias("ece"), F.sum("count").alias("n_samples"))


# ------------------------------------------------------------------ H17
def confusion_matrix(df: DataFrame, y: str = "y_true", p: str = "y_pred", classes: DataFrame | None = None) -> DataFrame:
    """All (true, predicted) class pairs with count and row-normalised rate (empty row -> 0).
    ``classes`` (one column ``cls``) defaults to the labels seen; it is small by
    construction (the label set), so the pair grid is label-count squared."""
    counts = df.groupBy(_c(y).alias("y_true"), _c(p).alias("y_pred")).agg(F.count(F.lit(1)).alias("count"))
    if classes is None:
        classes = counts.select(F.col("y_true").alias("cls")).union(counts.select(F.col("y_pred").alias("cls"))).distinct()
    label_set = classes.agg(F.array_sort(F.collect_set("cls"))).scalar()  # the label set: small by construction
    grid = classes.select(F.col("cls").alias("y_true"), F.explode(label_set).alias("y_pred"))
    full = grid.join(counts, ["y_true", "y_pred"], "left").fillna(0, ["count"])
    row_tot = F.sum("count").over(Window.partitionBy("y_true"))
    return full.withColumn("rate", F.when(row_tot == 0, F.lit(0.0)).otherwise(F.col("count") / row_tot))


# ------------------------------------------------------------------ H19
def residuals(df: DataFrame, row_id: str = "row_id", y: str = "y_true", p: str = "y_pred",
              max_points: int = 1000, seed: int = 0) -> DataFrame:
    """y - p per row, uniform seeded sample of at most ``max_points`` (bottom-n by hash)."""
    from quarry.operators.profile import sample_rows
    out = df.select(row_id, y, p, (_c(y) - _c(p)).alias("residual"))
    return sample_rows(out, row_id, max_points, seed)


# ------------------------------------------------------------------ H20
def _metric_expr(metric: str, y: Column, p: Column):
    e = y - p
    if metric == "mse":
        return F.avg(e * e)
    if metric == "rmse":
        return F.sqrt(F.avg(e * e))
    if metric == "mae":
        return F.avg(F.abs(e))
    if metric == "r2":
        sse, sst = F.sum(e * e), F.var_pop(y) * F.count(F.lit(1))
        return F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - sse / sst)
    if metric == "accuracy":
        return F.avg((y == p).cast("double"))
    raise ValueError(f"bootstrap metric '{metric}' not supported")


def poisson1_cdf(kmax: int = 24) -> list[float]:
    """CDF of Poisson(1) at k = 0..kmax-1, from the series e^-1 * sum 1/j!."""
    out, term, acc = [], math.exp(-1.0), 0.0
    for k in range(kmax):
        acc += term
        out.append(acc)
        term /= (k + 1)
    return out


def bootstrap_ci(df: DataFrame, metric: str = "rmse", row_id: str = "row_id", y: str = "y_true", p: str = "y_pred",
                 n_boot: int = 200, alpha: float = 0.05, seed: int = 0, method: str = "poisson") -> DataFrame:
    """Percentile bootstrap interval: metric, low, mid (point estimate), high, n_boot.

    ``poisson`` (default, scale path): every row gets an independent Poisson(1)
    weight per replicate from md5(seed:row_id:block) (four 32-bit uniforms per
    digest), and replicate metrics are weighted sums, one row per replicate and task:
    no shuffle of the n_boot*n fan-out. ``multinomial`` (reference semantics): n draws
    with replacement per replicate, draw d picks row hash(seed, d) mod n of a dense
    row index. The digests of both are taken many at a time (``operators.resample``)."""
    point = df.agg(_metric_expr(metric, F.col(y), F.col(p))).scalar()
    if method == "poisson":
        yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
        b = spread(df).select(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")).cast("binary").alias("key"),
                              yc.alias("_y"), pc.alias("_p"))
        e, eq = F.col("_y") - F.col("_p"), (F.col("_y") == F.col("_p")).cast("double")
        parts = {"w": F.lit(1.0)} | {"mse": {"we2": e * e}, "rmse": {"we2": e * e}, "mae": {"wae": F.abs(e)}, "accuracy": {"weq": eq},
                                     "r2": {"we2": e * e, "wy": F.col("_c"), "wy2": F.col("_c") * F.col("_c")}}.get(metric, {})
        if metric == "r2":  # needs the weighted spread of y: sums are taken around the overall mean, which keeps digits
            b = b.withColumn("_c", F.col("_y") - df.agg(F.avg(yc)).scalar())
        reps = poisson_sums(b, parts, n_boot, poisson1_cdf())
        sw = F.col("w")
        score = {
            "mse": lambda: F.col("we2") / sw, "rmse": lambda: F.sqrt(F.col("we2") / sw), "mae": lambda: F.col("wae") / sw,
            "accuracy": lambda: F.col("weq") / sw,
            "r2": lambda: F.when(F.col("wy2") - F.col("wy") * F.col("wy") / sw == 0, None).otherwise(
                F.lit(1.0) - F.col("we2") / (F.col("wy2") - F.col("wy") * F.col("wy") / sw)),
        }
        reps = reps.select("rep", score[metric]().alias("score"))
    elif method == "multinomial":
        yc, pc = F.col(y).cast("double"), F.col(p).cast("double")
        e = yc - pc
        x = {"mae": F.abs(e), "accuracy": (F.col(y) == F.col(p)).cast("double")}.get(metric, e * e)
        n = df.count()
        if n < 2:
            raise ValueError("bootstrap CI requires at least 2 rows")
        yv = F.lit(None)
        if metric == "r2":  # around the overall mean of the finite values, which keeps digits
            yv = yc - df.agg(F.coalesce(F.avg(F.when(F.abs(yc) < float("inf"), yc)), F.lit(0.0))).scalar()
        reps = draw_sums(df.select(row_id, x.alias("x"), yv.cast("double").alias("y")), row_id, n, n_boot, seed, metric == "r2")
        mean = F.try_divide("sx", "nx")
        if metric == "r2":
            sse = F.when(F.col("nx") > 0, F.col("sx"))
            sst = F.when((F.col("low") == F.col("high")) & ~F.isnan("low"), 0.0).otherwise(
                F.try_divide(F.col("sy2") - F.try_divide(F.col("sy") * F.col("sy"), F.col("ny")), F.col("ny")) * F.col("n"))
            score = F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(F.lit(1.0) - F.try_divide(sse, sst))
        else:
            score = F.sqrt(mean) if metric == "rmse" else mean
        reps = reps.select("rep", score.alias("score"))
    else:
        raise ValueError(f"unknown bootstrap method '{method}'")
    reps = reps.where(F.col("score").isNotNull() & ~F.isnan("score"))  # failed draws are skipped
    qs = reps.agg(F.percentile("score", F.array(F.lit(alpha / 2), F.lit(1 - alpha / 2))).alias("_q"),
                  F.count(F.lit(1)).alias("n_boot"))  # n_boot values: bounded
    return qs.select(F.lit(metric).alias("metric"), F.col("_q")[0].alias("low"), point.alias("mid"),
                     F.col("_q")[1].alias("high"), "n_boot")


# ------------------------------------------------------------------ H22 / H23 / H24
def conformal_quantile(df: DataFrame, y: str = "y_true", p: str = "y_pred", alpha: float = 0.1) -> DataFrame:
    """q = linear (1 - alpha) quantile of |y - p| (no finite-sample correction). One row."""
    r = df.select(F.lit("all").alias("_g"), F.abs(_c(y) - _c(p)).alias("_r"))
    q = exact_quantiles(r, ["_g"], "_r", [1 - alpha])
    return q.select(F.lit(alpha).alias("alpha"), F.col("value").alias("q"))


def conformal_interval(df: DataFrame, q: float, p: str = "y_pred") -> DataFrame:
    """[p - q, p + q] for a fitted q (finite, >= 0)."""
    if q is None or q < 0:
        raise ValueError("conformal q must be finite and >= 0")
    return df.withColumn("pred_lower", _c(p) - F.lit(q)).withColumn("pred_upper", _c(p) + F.lit(q))


def equal_width_hist(df: DataFrame, value: str, bins: int, group_cols: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram over [min, max] (min = max -> [v - 0.5, v + 0.5]), last bin closed.
    Output: (group..., bin, lo, hi, count) for non-empty bins."""
    g = list(group_cols)
    v = F.col(value)
    rng = df.where(v.isNotNull()).groupBy(*g).agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"))
    rng = (rng.withColumn("_lo", F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn")))
              .withColumn("_hi", F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx"))))
    if g:
        # one row per group (features in the profile queries); size-checked before broadcasting
        j = join_null_safe(df.where(v.isNotNull()), bounded_broadcast(rng), g)
    else:
        lo, hi = rng.select("_lo").scalar(), rng.select("_hi").scalar()
        j = df.where(v.isNotNull()).select("*", lo.alias("_lo"), hi.alias("_hi"))
    b = F.least(F.floor((v - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))), F.lit(bins - 1)).cast("bigint")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return j.groupBy(*g, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo0"), F.first("_hi").alias("_hi0")
    ).select(*g, "bin", (F.col("_lo0") + F.col("bin") * (F.col("_hi0") - F.col("_lo0")) / F.lit(bins)).alias("lo"),
             (F.col("_lo0") + (F.col("bin") + 1) * (F.col("_hi0") - F.col("_lo0")) / F.lit(bins)).alias("hi"), "count")


def interval_width_hist(intervals: DataFrame, lower: str = "pred_lower", upper: str = "pred_upper", bins: int = 20) -> DataFrame:
    w = intervals.select((F.col(upper) - F.col(lower)).alias("width"))
    return equal_width_hist(w.where(~F.isnan("width")), "width", bins)


# ------------------------------------------------------------------ H25 / H26
def metrics_report_regression(df: DataFrame, y: str = "y_true", p: str = "y_pred", primary: str = "r2") -> DataFrame:
    """Long (metric, value, direction, is_primary) table of the regression metric set."""
    m = regression_metrics(df, y, p)
    long = m.unpivot([], ["r2", "mse", "rmse", "mae"], "metric", "value")
    dir_expr = F.when(F.col("metric") == "r2", F.lit("maximize")).otherwise(F.lit("minimize"))
    return long.select("metric", "value", dir_expr.alias("direction"), (F.col("metric") == primary).alias("is_primary"))


def classification_report(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """label, precision, recall, f1, support: a row per class seen (zero division gives 0), the plain and the
    support-weighted means, and accuracy (in all three columns). One aggregate over the rows."""
    cc = class_counts(df.where(_c(y).isNotNull() & _c(p).isNotNull()), y, p)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    per = cc.select(F.col("cls").cast("string").alias("label"), F.when(tp + fp == 0, 0.0).otherwise(F.try_divide(tp, tp + fp)).alias("precision"),
                    F.when(tp + fn == 0, 0.0).otherwise(F.try_divide(tp, tp + fn)).alias("recall"), _fbeta(tp, fp, fn, 1.0).alias("f1"), "support", "tp")
    names = ("precision", "recall", "f1")
    total, weight = F.sum("support").alias("support"), F.col("support")
    macro = per.agg(*[F.avg(n).alias(n) for n in names], total).select(F.lit("macro avg").alias("label"), *names, "support")
    weighted = per.agg(*[F.try_divide(F.sum(F.col(n) * weight), F.sum(weight)).alias(n) for n in names], total).select(F.lit("weighted avg").alias("label"), *names, "support")
    share = F.try_divide(F.sum("tp"), F.sum("support"))
    accuracy = per.agg(*[share.alias(n) for n in names], total).select(F.lit("accuracy").alias("label"), *names, "support")
    return per.drop("tp").unionByName(macro).unionByName(weighted).unionByName(accuracy)


def prediction_sample(df: DataFrame, row_id: str = "row_id", cols: Sequence[str] = ("y_true", "y_pred"), n: int = 5) -> DataFrame:
    """First n rows by row id (the limit is the feature)."""
    return df.select(row_id, *cols).orderBy(row_id).limit(n)
