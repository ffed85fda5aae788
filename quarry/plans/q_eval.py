"""Evaluation queries (H*) on PRED_R (regression), PRED_C (binary) and PRED_M
(three-class) prediction tables over the whole orders / lineitem tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import sql_hash_unit, sql_hash_wide
from quarry.operators import evaluate as H
from quarry.plans.registry import register, rnd
from quarry.plans.views import pred_c, pred_m, pred_r, with_views


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


_REG_AGG = """SELECT count(*) AS n, avg((y_true - y_pred) * (y_true - y_pred)) AS mse, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
       avg(abs(y_true - y_pred)) AS mae,
       CASE WHEN var_pop(y_true) * count(*) = 0 THEN (CASE WHEN sum((y_true - y_pred) * (y_true - y_pred)) = 0 THEN 1.0 ELSE 0.0 END)
            ELSE 1.0 - sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*)) END AS r2 FROM pred_r"""

for _m in ("mse", "rmse", "mae", "r2"):
    def _mk(m):
        @register(f"metric_{m}", Q(["pred_r"], f"SELECT {m} FROM ({_REG_AGG})", m))
        def _q(spark, sf_dir):
            return H.regression_metrics(pred_r(spark, sf_dir)).select(m)
        _q.__doc__ = f"H1/H2: {m} of the fixed regression predictor"
    _mk(_m)

_CC = """cc AS (SELECT cls, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn, sum(sup) AS support FROM (
    SELECT y_true AS cls, CASE WHEN y_true = y_pred THEN 1 ELSE 0 END AS tp, 0 AS fp, CASE WHEN y_true <> y_pred THEN 1 ELSE 0 END AS fn, 1 AS sup FROM {t}
    UNION ALL
    SELECT y_pred AS cls, 0, CASE WHEN y_true <> y_pred THEN 1 ELSE 0 END, 0, 0 FROM {t}) GROUP BY cls),
ccf AS (SELECT *, CASE WHEN (1 + {b2}) * tp + {b2} * fn + fp = 0 THEN 0.0 ELSE (1 + {b2}) * tp / ((1 + {b2}) * tp + {b2} * fn + fp) END AS f FROM cc)
"""


def _cls_sql(t: str, beta: float) -> str:
    return _CC.format(t=t, b2=repr(beta * beta))


_CLS_SELECT = """SELECT sum(tp)::DOUBLE / sum(support) AS accuracy,
       avg(CASE WHEN support > 0 THEN tp::DOUBLE / support END) AS balanced_accuracy,
       max(CASE WHEN cls = 1 THEN f END) AS f_binary, avg(f) AS f_macro,
       CASE WHEN (1 + {b2}) * sum(tp) + {b2} * sum(fn) + sum(fp) = 0 THEN 0.0
            ELSE (1 + {b2}) * sum(tp) / ((1 + {b2}) * sum(tp) + {b2} * sum(fn) + sum(fp)) END AS f_micro,
       sum(f * support) / sum(support) AS f_weighted FROM ccf"""


def _cls_q(view, beta, cols):
    b2 = repr(beta * beta)
    body = ", " + _cls_sql(view, beta) + f"SELECT {', '.join(cols)} FROM ({_CLS_SELECT.format(b2=b2)})"
    return Q([view], body, *cols)


@register("metric_accuracy", _cls_q("pred_m", 1.0, ["accuracy"]))
def q_accuracy(spark, sf_dir):
    """H3: accuracy of the three-class predictor."""
    return H.classification_metrics(pred_m(spark, sf_dir)).select("accuracy")


@register("metric_f1", _cls_q("pred_m", 1.0, ["f_macro", "f_micro", "f_weighted"]))
def q_f1(spark, sf_dir):
    """H4: macro / micro / weighted F1 of the three-class predictor."""
    return H.classification_metrics(pred_m(spark, sf_dir)).select("f_macro", "f_micro", "f_weighted")


@register("metric_f1_binary", _cls_q("pred_c", 1.0, ["f_binary", "f_macro"]))
def q_f1_binary(spark, sf_dir):
    """H4: binary F1 (positive class 1) of the binary predictor."""
    return H.classification_metrics(pred_c(spark, sf_dir)).select("f_binary", "f_macro")


@register("metric_fbeta", _cls_q("pred_c", 2.0, ["f_binary", "f_macro", "f_weighted"]))
def q_fbeta(spark, sf_dir):
    """H5: F-beta with beta = 2."""
    return H.classification_metrics(pred_c(spark, sf_dir), beta=2.0).select("f_binary", "f_macro", "f_weighted")


@register("metric_balanced_accuracy", _cls_q("pred_m", 1.0, ["balanced_accuracy"]))
def q_bal(spark, sf_dir):
    """H6."""
    return H.classification_metrics(pred_m(spark, sf_dir)).select("balanced_accuracy")


_PER = """, per AS (SELECT p AS s, sum(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y_true <> 1 THEN 1 ELSE 0 END) AS neg
         FROM pred_c GROUP BY p)
"""


@register("metric_roc_auc", Q(["pred_c"], _PER + """,
cum AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM per)
SELECT sum(pos * (neg_below + 0.5 * neg))::DOUBLE / (sum(pos) * sum(neg))::DOUBLE AS roc_auc FROM cum""", "roc_auc"))
def q_roc_auc(spark, sf_dir):
    """H7: ROC AUC of the binary scores."""
    return H.roc_auc(pred_c(spark, sf_dir))


_DESC = _PER + """,
dc AS (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(neg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp FROM per)
"""


@register("metric_pr_auc", Q(["pred_c"], _DESC + "SELECT sum(pos * (tp::DOUBLE / (tp + fp))) / sum(pos)::DOUBLE AS pr_auc FROM dc", "pr_auc"))
def q_pr_auc(spark, sf_dir):
    """H8: average precision."""
    return H.average_precision(pred_c(spark, sf_dir))


@register("roc_curve", Q(["pred_c"], _DESC + """
SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT s, fp::DOUBLE / (SELECT sum(neg) FROM per), tp::DOUBLE / (SELECT sum(pos) FROM per) FROM dc""", "threshold", "fpr", "tpr"))
def q_roc_curve(spark, sf_dir):
    """ROC points per distinct score."""
    return H.roc_curve(pred_c(spark, sf_dir))


_EPS = repr(H.EPS)
_ONE_EPS = repr(1 - H.EPS)


@register("metric_log_loss", Q(["pred_c"], f"""
SELECT -avg(CASE WHEN y_true = 1 THEN ln(pc / (pc + qc)) ELSE ln(qc / (pc + qc)) END) AS log_loss
FROM (SELECT y_true, least(greatest(p, {_EPS}), {_ONE_EPS}) AS pc, least(greatest(1.0 - p, {_EPS}), {_ONE_EPS}) AS qc FROM pred_c)""", "log_loss"))
def q_log_loss(spark, sf_dir):
    """H9: binary log-loss."""
    return H.log_loss_binary(pred_c(spark, sf_dir))


@register("metric_log_loss_multiclass", Q(["pred_m"], f"""
SELECT -avg(ln((CASE y_true WHEN 0 THEN c0 WHEN 1 THEN c1 ELSE c2 END) / (c0 + c1 + c2))) AS log_loss
FROM (SELECT y_true, least(greatest(p0, {_EPS}), {_ONE_EPS}) AS c0, least(greatest(p1, {_EPS}), {_ONE_EPS}) AS c1,
             least(greatest(p2, {_EPS}), {_ONE_EPS}) AS c2 FROM pred_m)""", "log_loss"))
def q_log_loss_m(spark, sf_dir):
    """H9: multiclass log-loss."""
    return H.log_loss_multiclass(pred_m(spark, sf_dir))


_GRID = "[" + ", ".join(repr(t) for t in H.THRESHOLD_GRID) + "]"


@register("threshold_search", Q(["pred_c"], f""",
g AS (SELECT unnest({_GRID}) AS t),
c AS (SELECT t, count(*) FILTER (WHERE p >= t AND y_true = 1) AS tp, count(*) FILTER (WHERE p >= t AND y_true <> 1) AS fp,
             count(*) FILTER (WHERE p < t AND y_true = 1) AS fn, count(*) FILTER (WHERE p < t AND y_true <> 1) AS tn
      FROM pred_c CROSS JOIN g GROUP BY t),
s AS (SELECT *, CASE WHEN 2.0 * tp + fn + fp = 0 THEN 0.0 ELSE 2.0 * tp / (2.0 * tp + fn + fp) END AS score FROM c)
SELECT t AS threshold, tp, fp, fn, tn, score, row_number() OVER (ORDER BY score DESC, t ASC) = 1 AS is_best FROM s""",
                                   "threshold", "score"))
def q_threshold(spark, sf_dir):
    """F1 over the 0.05..0.95 grid; lowest threshold wins ties."""
    return H.threshold_search(pred_c(spark, sf_dir))


@register("calibration_curve", Q(["pred_c"], """
SELECT CAST(least(floor(conf * 10), 9) AS BIGINT) AS bin, count(*) AS count, avg(conf) AS mean_confidence, avg(correct) AS mean_accuracy
FROM (SELECT least(greatest(p, 0.0), 1.0) AS conf, CASE WHEN y_true = 1 THEN 1.0 ELSE 0.0 END AS correct FROM pred_c) GROUP BY 1""",
                                    "mean_confidence", "mean_accuracy"))
def q_calibration(spark, sf_dir):
    """Reliability curve of the binary scores."""
    return H.calibration_curve(pred_c(spark, sf_dir))


@register("calibration_ece", Q(["pred_m"], """
SELECT sum(count * abs(acc - conf)) / sum(count) AS ece, sum(count)::BIGINT AS n_samples FROM (
  SELECT least(floor(c * 10), 9) AS bin, count(*) AS count, avg(c) AS conf, avg(ok) AS acc FROM (
    SELECT least(greatest(greatest(p0, p1, p2), 0.0), 1.0) AS c,
           CASE WHEN (CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END) = y_true THEN 1.0 ELSE 0.0 END AS ok
    FROM pred_m) GROUP BY 1)""", "ece"))
def q_ece(spark, sf_dir):
    """Expected calibration error, multiclass top-1."""
    return H.calibration_ece(H.calibration_curve(pred_m(spark, sf_dir), score=None, proba="proba"))


@register("confusion_matrix", Q(["pred_m"], """,
cnt AS (SELECT y_true, y_pred, count(*) AS count FROM pred_m GROUP BY ALL),
labs AS (SELECT y_true AS c FROM cnt UNION SELECT y_pred FROM cnt),
full_ AS (SELECT a.c AS y_true, b.c AS y_pred, coalesce(n.count, 0) AS count FROM labs a CROSS JOIN labs b
          LEFT JOIN cnt n ON n.y_true = a.c AND n.y_pred = b.c)
SELECT y_true, y_pred, count, CASE WHEN sum(count) OVER (PARTITION BY y_true) = 0 THEN 0.0
                                  ELSE count::DOUBLE / sum(count) OVER (PARTITION BY y_true) END AS rate FROM full_""", "rate"))
def q_confusion(spark, sf_dir):
    """All class pairs with counts and row-normalised rates."""
    return H.confusion_matrix(pred_m(spark, sf_dir))


@register("residuals", Q(["pred_r"], f"""
SELECT row_id, y_true, y_pred, y_true - y_pred AS residual FROM pred_r
ORDER BY {sql_hash_unit(0, 'row_id')}, row_id LIMIT 1000""", "y_true", "y_pred", "residual"))
def q_residuals(spark, sf_dir):
    """1000 seeded sample points of y - p (the sample size is the feature)."""
    return H.residuals(pred_r(spark, sf_dir))


@register("bootstrap_ci_multinomial", Q(["pred_r"], f""",
r AS (SELECT y_true, y_pred, row_number() OVER (ORDER BY row_id) - 1 AS idx FROM pred_r),
nn AS (SELECT count(*) AS n FROM pred_r),
d AS (SELECT range AS id FROM range(0, 200 * (SELECT n FROM nn))),
dr AS (SELECT id // (SELECT n FROM nn) AS rep, {sql_hash_wide(0, 'id')} % (SELECT n FROM nn) AS idx FROM d),
reps AS (SELECT rep, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS score FROM dr JOIN r USING (idx) GROUP BY rep)
SELECT 'rmse' AS metric, quantile_cont(score, 0.025) AS low,
       (SELECT sqrt(avg((y_true - y_pred) * (y_true - y_pred))) FROM pred_r) AS mid,
       quantile_cont(score, 0.975) AS high, count(*) AS n_boot FROM reps""", "low", "mid", "high"))
def q_bootstrap_multi(spark, sf_dir):
    """H20 (reference semantics): 200 resamples of n draws with replacement, RMSE."""
    return H.bootstrap_ci(pred_r(spark, sf_dir), "rmse", method="multinomial")


_CDF = "[" + ", ".join(repr(c) for c in H.poisson1_cdf()) + "]"


@register("bootstrap_ci", Q(["pred_r"], f""",
b AS (SELECT y_true, y_pred, blk, md5(concat_ws(':', '0', row_id, CAST(blk AS VARCHAR))) AS m FROM pred_r, range(0, 50) t(blk)),
u AS (SELECT y_true, y_pred, blk * 4 + j AS rep, ('0x' || substr(m, 1 + 8 * j, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM b, range(0, 4) s(j)),
w AS (SELECT rep, y_true, y_pred, len(list_filter({_CDF}, lambda t: t <= u))::DOUBLE AS w FROM u WHERE rep < 200),
reps AS (SELECT rep, sqrt(sum(w * (y_true - y_pred) * (y_true - y_pred)) / sum(w)) AS score FROM w GROUP BY rep)
SELECT 'rmse' AS metric, quantile_cont(score, 0.025) AS low,
       (SELECT sqrt(avg((y_true - y_pred) * (y_true - y_pred))) FROM pred_r) AS mid,
       quantile_cont(score, 0.975) AS high, count(*) AS n_boot FROM reps""", "low", "mid", "high"))
def q_bootstrap(spark, sf_dir):
    """H20 at scale: 200-replicate Poisson bootstrap of RMSE over all rows."""
    return H.bootstrap_ci(pred_r(spark, sf_dir), "rmse", method="poisson")


@register("conformal_quantile", Q(["pred_r"], "SELECT 0.1 AS alpha, quantile_cont(abs(y_true - y_pred), 0.9) AS q FROM pred_r", "alpha", "q"))
def q_conformal_q(spark, sf_dir):
    """Split-conformal half-width at alpha = 0.1."""
    return H.conformal_quantile(pred_r(spark, sf_dir), alpha=0.1)


def _conf_interval(spark, sf_dir):
    pr = pred_r(spark, sf_dir)
    q = H.conformal_quantile(pr, alpha=0.1).select("q").first()[0]  # one fitted scalar
    return H.conformal_interval(pr.select("row_id", "y_pred"), q)


@register("conformal_interval", Q(["pred_r"], """,
qq AS (SELECT quantile_cont(abs(y_true - y_pred), 0.9) AS q FROM pred_r)
SELECT row_id, y_pred, y_pred - (SELECT q FROM qq) AS pred_lower, y_pred + (SELECT q FROM qq) AS pred_upper FROM pred_r""",
                                     "y_pred", "pred_lower", "pred_upper"))
def q_conformal_interval(spark, sf_dir):
    """[p - q, p + q] for every row."""
    return _conf_interval(spark, sf_dir)


@register("interval_width_hist", Q(["pred_r"], """,
qq AS (SELECT quantile_cont(abs(y_true - y_pred), 0.9) AS q FROM pred_r),
w AS (SELECT (y_pred + (SELECT q FROM qq)) - (y_pred - (SELECT q FROM qq)) AS width FROM pred_r),
rg AS (SELECT CASE WHEN min(width) = max(width) THEN min(width) - 0.5 ELSE min(width) END AS lo,
              CASE WHEN min(width) = max(width) THEN max(width) + 0.5 ELSE max(width) END AS hi FROM w)
SELECT bin, lo + bin * (hi - lo) / 20 AS lo, lo + (bin + 1) * (hi - lo) / 20 AS hi, count FROM (
  SELECT CAST(least(floor((width - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS count
  FROM w CROSS JOIN rg GROUP BY 1)""", "lo", "hi"))
def q_width_hist(spark, sf_dir):
    """20-bin histogram of interval widths."""
    return H.interval_width_hist(_conf_interval(spark, sf_dir))


@register("metrics_report", Q(["pred_r"], f"""
SELECT metric, value, CASE WHEN metric = 'r2' THEN 'maximize' ELSE 'minimize' END AS direction, metric = 'r2' AS is_primary
FROM ({_REG_AGG}) UNPIVOT (value FOR metric IN (r2, mse, rmse, mae))""", "value"))
def q_metrics_report(spark, sf_dir):
    """Long metric table with direction and primary flag."""
    return H.metrics_report_regression(pred_r(spark, sf_dir))


@register("prediction_sample", Q(["pred_r"], "SELECT row_id, y_true, y_pred FROM pred_r ORDER BY row_id LIMIT 5", "y_true", "y_pred"))
def q_pred_sample(spark, sf_dir):
    """First 5 predictions by row id."""
    return H.prediction_sample(pred_r(spark, sf_dir))


@register("positive_proba", Q(["pred_m"], "SELECT row_id, p1 AS positive_proba FROM pred_m", "positive_proba"))
def q_pos_proba(spark, sf_dir):
    """Second probability column of a probability array."""
    return pred_m(spark, sf_dir).select("row_id", H.positive_proba("proba").alias("positive_proba"))
