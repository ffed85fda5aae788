"""Queries of the fitted estimators that have a module of their own: nearest neighbours, RBF features, bootstrap of
probability metrics, gated scoring, regressors, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import hash_uniform, sql_hash_wide
from quarry.operators import bootstrap as B
from quarry.operators import bundle as BU
from quarry.operators import evaluate as H
from quarry.operators import models as G
from quarry.operators import neighbours as N
from quarry.operators import splits as E
from quarry.operators import train as T
from quarry.plans import sql_models as M
from quarry.plans.q_misc import CF, CLS_FIT, _over_event_batches, cls_scaled
from quarry.plans.q_prep import REG_TRAIN, cls_rule, reg_rule
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, pred_c, pred_m, reg, table, with_views
from quarry.session import scratch_path
from quarry.sources import io as A
from quarry.streaming import scoring as L


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


# ------------------------------------------------------------------ G9
_KNN = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS v, label FROM embeddings),
d AS (SELECT q.vec_id, t.vec_id AS neighbour, t.label AS y, sqrt(list_sum(list_transform(list_zip(q.v, t.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS distance
      FROM e q JOIN e t ON q.vec_id % 5 = 0 AND t.vec_id % 5 <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM d QUALIFY rank <= 5)
"""


@register("fit_knn", rnd(_KNN + """,
v AS (SELECT vec_id, y, count(*) AS c FROM n GROUP BY vec_id, y)
SELECT vec_id, label::BIGINT AS y_true, (SELECT y::BIGINT FROM v WHERE v.vec_id = e.vec_id ORDER BY c DESC, y LIMIT 1) AS y_pred,
       (SELECT avg(y) FROM n WHERE n.vec_id = e.vec_id) AS mean FROM e WHERE vec_id % 5 = 0""", "mean"))
def q_knn(spark, sf_dir):
    """Each fifth embedding classified, and its label averaged, by its five nearest of all others."""
    e = table(spark, sf_dir, "embeddings")
    train, scored = e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0)
    near = N.nearest_neighbours(train, scored, "embedding", 5, "vec_id")
    cls_ = N.knn_predict(near, train, "label", row_id="vec_id").withColumnRenamed("prediction", "y_pred")
    mean = N.knn_predict(near, train, "label", "regression", "vec_id").withColumnRenamed("prediction", "mean")
    return scored.select("vec_id", F.col("label").alias("y_true")).join(cls_, "vec_id").join(mean, "vec_id")


@register("knn_neighbours", rnd(_KNN + "SELECT vec_id, neighbour, distance, rank FROM n", "distance"))
def q_knn_rows(spark, sf_dir):
    """The five nearest of all other embeddings, with their distances."""
    e = table(spark, sf_dir, "embeddings")
    near = N.nearest_neighbours(e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0), "embedding", 5, "vec_id")
    return near.withColumnRenamed("id", "vec_id")


# ------------------------------------------------------------------ G11
@register("fit_rbf_svc")
def q_rbf(spark, sf_dir):
    """RBF support vector classifier (random Fourier features) on scaled CLS rows; validation metrics."""
    tr, va = cls_scaled(spark, sf_dir)
    model, names, gamma = N.fit_rbf_svc(tr.withColumn("y", F.col("label").cast("double")), CF, "y", components=60)
    ready, _ = N.fourier_features(va, CF, gamma, 60)
    pred = model.transform(G.assemble(ready, names)).select(F.col("label").alias("y_true"), F.col("prediction").cast("bigint").alias("y_pred"))
    return H.classification_metrics(pred).select("accuracy", "f_binary", "balanced_accuracy")


# ------------------------------------------------------------------ H20
_REPS = 16


def _weights(seed: int, rows: str) -> str:
    """CTE w: the rows with replicate number k and Poisson weight, as in quarry.operators.bootstrap."""
    factors = ", ".join(f"({k}, {int(f)}::UHUGEINT)" for k, f in enumerate(B.replicate_factors(seed, _REPS)))
    case = " ".join(f"WHEN u < {c!r}::DOUBLE THEN {i}" for i, c in enumerate(H.poisson1_cdf()))
    return f"""f(k, factor) AS (VALUES {factors}),
u AS (SELECT r.*, k, (({sql_hash_wide(seed, 'row_id')})::UHUGEINT * factor % 18446744073709551616::UHUGEINT // 4294967296::UHUGEINT)::DOUBLE / 4294967296.0 AS u FROM {rows} r, f),
w AS (SELECT * EXCLUDE (u), (CASE {case} ELSE 24 END)::DOUBLE AS w FROM u)"""


def _ranked_sql(name: str, extra: str = "") -> str:
    """CTE: ROC AUC and average precision by replicate (and ``extra`` key) of rows y, s, w."""
    key = "k" + (", " + extra if extra else "")
    return f"""{name}_g AS (SELECT {key}, s, sum(CASE WHEN y = 1 THEN w ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE w END) AS neg FROM {name}_w GROUP BY {key}, s),
{name}_c AS (SELECT *, sum(neg) OVER (PARTITION BY {key} ORDER BY s) - neg AS below, sum(pos) OVER (PARTITION BY {key} ORDER BY s DESC) AS tp,
             sum(neg) OVER (PARTITION BY {key} ORDER BY s DESC) AS fp FROM {name}_g),
{name} AS (SELECT {key}, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc,
           sum(CASE WHEN pos > 0 THEN pos * tp / (tp + fp) ELSE 0 END) / sum(pos) AS pr_auc FROM {name}_c GROUP BY {key})"""


def _row(metric: str, reps: str, mid: str) -> str:
    return (f"SELECT '{metric}' AS metric, quantile_cont({metric}, 0.025) AS low, ({mid}) AS mid, quantile_cont({metric}, 0.975) AS high, count({metric}) AS n_boot FROM {reps}")


_CLIP = "least(greatest({0}, 2.220446049250313e-16), 1 - 2.220446049250313e-16)"


@register("bootstrap_ci_proba", Q(["pred_c"], ", " + _weights(3, "(SELECT row_id, y_true AS y, p AS s FROM pred_c)") + """,
r_w AS (SELECT * FROM w), """ + _ranked_sql("r") + """,
p_w AS (SELECT 0 AS k, y_true AS y, p AS s, 1.0 AS w FROM pred_c), """ + _ranked_sql("p") + f""",
l AS (SELECT *, -ln(CASE WHEN y = 1 THEN {_CLIP.format('s')} ELSE {_CLIP.format('(1 - s)')} END) AS loss, s >= 0.5 AS hit FROM w),
m AS (SELECT k, sum(w * loss) / sum(w) AS log_loss, 2 * sum(CASE WHEN hit AND y = 1 THEN w ELSE 0 END)
             / (2 * sum(CASE WHEN hit AND y = 1 THEN w ELSE 0 END) + sum(CASE WHEN hit <> (y = 1) THEN w ELSE 0 END)) AS f1 FROM l GROUP BY k),
o AS (SELECT avg(loss) AS log_loss, 2.0 * count(*) FILTER (WHERE hit AND y = 1) / (2 * count(*) FILTER (WHERE hit AND y = 1) + count(*) FILTER (WHERE hit <> (y = 1))) AS f1 FROM l WHERE k = 0)
""" + " UNION ALL ".join([_row("roc_auc", "r", "SELECT roc_auc FROM p"), _row("pr_auc", "r", "SELECT pr_auc FROM p"),
                           _row("log_loss", "m", "SELECT log_loss FROM o"), _row("f1", "m", "SELECT f1 FROM o")]), "low", "mid", "high"))
def q_boot_proba(spark, sf_dir):
    """Intervals of ROC AUC, average precision, log-loss and F1 of the binary scores."""
    pc, out = pred_c(spark, sf_dir), None
    for metric in ("roc_auc", "pr_auc", "log_loss", "f1"):
        one = B.bootstrap_ci_proba(pc, metric, n_boot=_REPS, seed=3)
        out = one if out is None else out.unionByName(one)
    return out


@register("bootstrap_ci_multiclass", Q(["pred_m"], ", " + _weights(4, "(SELECT row_id, y_true, p0, p1, p2 FROM pred_m)") + """,
c AS (SELECT unnest([0, 1, 2]) AS c),
r_w AS (SELECT k, c, CASE WHEN y_true = c THEN 1 ELSE 0 END AS y, CASE c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS s, w FROM w, c), """ + _ranked_sql("r", "c") + """,
p_w AS (SELECT 0 AS k, c, CASE WHEN y_true = c THEN 1 ELSE 0 END AS y, CASE c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS s, 1.0 AS w FROM pred_m, c), """ + _ranked_sql("p", "c") + f""",
a AS (SELECT k, avg(roc_auc) AS roc_auc, avg(pr_auc) AS pr_auc FROM r GROUP BY k),
own AS (SELECT k, w, {_CLIP.format('(CASE y_true WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END)')} AS s FROM w),
m AS (SELECT k, sum(-w * ln(s)) / sum(w) AS log_loss FROM own GROUP BY k)
""" + " UNION ALL ".join([_row("roc_auc", "a", "SELECT avg(roc_auc) FROM p"), _row("pr_auc", "a", "SELECT avg(pr_auc) FROM p"),
                           _row("log_loss", "m", "SELECT avg(-ln(s)) FROM own WHERE k = 0")]), "low", "mid", "high"))
def q_boot_multi(spark, sf_dir):
    """H20 for three classes: one against the rest, averaged, and log-loss."""
    return B.bootstrap_ci_multiclass(pred_m(spark, sf_dir), 3, ("roc_auc", "pr_auc", "log_loss"), n_boot=_REPS, seed=4)


# ------------------------------------------------------------------ I8 / A13 / A16
_QUARTER = "coalesce(CAST(floor((event_id % 4000) / 1000) AS BIGINT), 3)"
_GATED = f"""WITH q AS (SELECT {_QUARTER} AS chunk, value FROM events),
c AS (SELECT chunk, count(*) AS rows_in, count(*) FILTER (WHERE value >= 20 AND value <= 90) AS rows_out, count(*) FILTER (WHERE value < 20) AS low,
             count(*) FILTER (WHERE value > 90) AS high, sum(CASE WHEN value >= 20 AND value <= 90 THEN 2.0 * value + 1.0 ELSE 0 END) AS total FROM q GROUP BY chunk),
p AS (SELECT *, sum(rows_in) OVER (ORDER BY chunk) AS row_end FROM c)
"""


@register("score_batch_gated", rnd(_GATED + """SELECT chunk, row_end - rows_in AS row_start, row_end, rows_in, rows_out, low + high AS issues, total FROM p""", "total"))
def q_score_gated(spark, sf_dir):
    """I8 + A13: events scored in four micro-batches, rows outside the valid range dropped, predictions appended once."""
    state, prediction = scratch_path(spark, "gated"), F.lit(2.0) * F.col("value") + F.lit(1.0)
    out = _over_event_batches(spark, sf_dir, lambda s: L.score_exactly_once(
        s, lambda b: b.select("event_id", prediction.alias("prediction")), state, _checks(), "drop", lambda b: ("pass", [])))
    total = out.groupBy("chunk").agg(F.sum("prediction").alias("total"))
    return L.finished_batches(spark, state).drop("v").join(total, "chunk", "left").fillna(0.0, ["total"])


def _checks():
    return {"value_low": F.expr("value < 20"), "value_high": F.expr("value > 90")}


@register("score_error_log", _GATED + """SELECT chunk, row_end - rows_in AS row_start, row_end, 'value_low' AS reason, low AS rows FROM p WHERE low > 0
UNION ALL SELECT chunk, row_end - rows_in, row_end, 'value_high', high FROM p WHERE high > 0""")
def q_error_log(spark, sf_dir):
    """The error log of the same run, a row per batch and reason with the batch's row range."""
    state = scratch_path(spark, "gated")
    _over_event_batches(spark, sf_dir, lambda s: L.score_exactly_once(s, lambda b: b.select("event_id"), state, _checks(), "warn"))
    return L.error_log(spark, state).select("chunk", "row_start", "row_end", "reason", "rows")


# ------------------------------------------------------------------ G7 / G8 regressors, through bundles
def _regressor(kind: str, **params):
    @register(f"fit_{kind}_regressor")
    def run(spark, sf_dir):
        r, sp = reg(spark, sf_dir), reg_rule(spark, sf_dir)
        tr, va = E.apply_split(r, sp, "row_id", "train"), E.apply_split(r, sp, "row_id", "val")
        fitted = BU.fit_bundle(tr, "target", ["quantity", "discount", "tax"], ["returnflag"], model=kind, params=params)
        back = BU.load_bundle(spark, BU.save_bundle(fitted, A.shared_scratch(spark, "bundle")))
        pred = back.score(va, ["target"]).select(F.col("target").alias("y_true"), F.col("prediction").alias("y_pred"))
        return H.regression_metrics(pred).select(F.lit(kind).alias("model"), "r2", "rmse", "mae")
    run.__doc__ = f"G7 / G8: {kind} regressor in a saved and loaded bundle; validation metrics."


_regressor("random_forest", numTrees=20, maxDepth=6)
_regressor("gradient_boosting", maxIter=15, maxDepth=3, stepSize=0.3)


# ------------------------------------------------------------------ H25 for classifiers
@register("classification_report", Q(["pred_m"], """,
k AS (SELECT unnest([0, 1, 2])::BIGINT AS cls),
c AS (SELECT cls, (SELECT count(*) FROM pred_m WHERE y_true = cls AND y_pred = cls)::DOUBLE AS tp, (SELECT count(*) FROM pred_m WHERE y_true <> cls AND y_pred = cls) AS fp,
             (SELECT count(*) FROM pred_m WHERE y_true = cls AND y_pred <> cls) AS fn FROM k),
r AS (SELECT CAST(cls AS VARCHAR) AS label, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
             CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, (tp + fn)::BIGINT AS support FROM c)
SELECT * FROM r
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM r
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM r
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS a, count(*) AS n FROM pred_m)""", "precision", "recall", "f1"))
def q_cls_report(spark, sf_dir):
    """Per class precision, recall, F1 and support, with macro and weighted means and accuracy."""
    return H.classification_report(pred_m(spark, sf_dir))


@register("fit_logistic_validation", Q(["cls"], CLS_FIT + M.logistic("w", "tf", ["f0", "f1", "f2"], "label", 1.0) + """,
o AS (SELECT label AS y, 1 / (1 + exp(-(b0 + b1 * f0 + b2 * f1 + b3 * f2))) AS p FROM vf, w)
SELECT avg(CASE WHEN (p >= 0.5) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, -avg(CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss, count(*) AS n FROM o""",
                                       "accuracy", "log_loss"))
def q_logit_valid(spark, sf_dir):
    """The logistic model's accuracy and log-loss on the validation rows."""
    tr, va = cls_scaled(spark, sf_dir)
    p = G.logistic_proba(G.newton_logistic(tr, CF, "label", l2=1.0)[0], CF)[1]
    y = F.col("label")
    return va.select(y, p.alias("p")).agg(F.avg(((F.col("p") >= 0.5) == (y == 1)).cast("double")).alias("accuracy"),
                                          (-F.avg(F.when(y == 1, F.ln("p")).otherwise(F.ln(1 - F.col("p"))))).alias("log_loss"), F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ G18
@register("train_task_regression", Q(["reg"], REG_TRAIN + """,
m AS (SELECT avg(quantity) AS mq FROM tr),
w AS (SELECT regr_slope(target, coalesce(quantity, mq)) AS w, regr_intercept(target, coalesce(quantity, mq)) AS b FROM tr, m),
p AS (SELECT target AS y, b + w * coalesce(quantity, mq) AS p FROM reg, w, m WHERE row_id IN (SELECT row_id FROM sp WHERE split = 'val'))
SELECT unnest(['r2', 'mse', 'rmse', 'mae']) AS metric, unnest([1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), avg((y - p) * (y - p)), sqrt(avg((y - p) * (y - p))), avg(abs(y - p))]) AS value,
       unnest(['maximize', 'minimize', 'minimize', 'minimize']) AS direction, unnest([true, false, false, false]) AS is_primary FROM p""", "value"))
def q_train_reg(spark, sf_dir):
    """Recipe, least squares, conformal width, bundle and validation report in one program."""
    return T.train_task(reg(spark, sf_dir), reg_rule(spark, sf_dir), "row_id", "target", ["quantity"], [], A.shared_scratch(spark, "train"),
                        conformal_alpha=0.1, n_boot=20).report


@register("train_task_classification")
def q_train_cls(spark, sf_dir):
    """G18 for two classes: oversampled train rows, logistic model, threshold by F1, report and AUC interval."""
    c = cls(spark, sf_dir).withColumn("y", F.when(F.col("status") == "F", "F").otherwise("other"))
    out = T.train_task(c, cls_rule(spark, sf_dir), "row_id", "y", ["totalprice", "acctbal"], ["priority"], A.shared_scratch(spark, "train"), "classification",
                       "logistic", "oversample", threshold_metric="f1", n_boot=20)
    low, high = out.interval.select("low").scalar(), out.interval.select("high").scalar()
    return out.report.select("*", low.alias("auc_low"), high.alias("auc_high"), F.lit(out.bundle.spec["threshold"]).alias("threshold"))
