"""Leaderboard / ensemble (J*) and scoring (I*) queries. RUNS holds the metrics of
four fixed predictors per supplier (one board per supplier), computed from the
whole lineitem table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import hash_bucket, sql_hash_unit
from quarry.operators import leaderboard as J
from quarry.operators import scoring as I
from quarry.operators.preprocess import label_encode
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, pred_m, reg, runs, with_views

METRICS = ["r2", "rmse", "mae", "mse"]


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


_REQ = ["primary_metric", "direction", "dataset_id", "split_hash", "recipe_hash", "model", "best_score"]


@register("runs_required_fields", Q(["runs"], f"""
SELECT board, run_id, concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN 'missing_{c}' END" for c in _REQ)}) AS reasons,
       ({' AND '.join(f'{c} IS NOT NULL' for c in _REQ)}) AS ok
FROM (SELECT *, r2 AS best_score FROM runs)"""))
def q_required(spark, sf_dir):
    """J1."""
    return J.runs_required_fields(runs(spark, sf_dir))


_KEYS = ["dataset_id", "split_hash", "primary_metric", "direction", "seed"]


@register("runs_comparable", Q(["runs"], f""",
ref AS (SELECT board, {', '.join(f'arg_min({k}, run_order) FILTER (WHERE {k} IS NOT NULL) AS ref_{k}' for k in _KEYS)} FROM runs GROUP BY board),
x AS (SELECT r.board, run_id, [{', '.join(f"CASE WHEN {k} IS NULL OR {k} <> ref_{k} THEN '{k}_mismatch' END" for k in _KEYS)}] AS rs
      FROM runs r JOIN ref USING (board))
SELECT board, run_id, len(list_filter(rs, lambda v: v IS NOT NULL)) = 0 AS comparable, concat_ws(',', {', '.join(f'rs[{i + 1}]' for i in range(len(_KEYS)))}) AS reasons FROM x"""))
def q_comparable(spark, sf_dir):
    """Runs that differ from the board's reference split / metric / seed."""
    return J.runs_comparable(runs(spark, sf_dir))


_LONG = f"SELECT board, run_id, run_order, metric, value FROM (SELECT board, run_id, run_order, {', '.join(METRICS)} FROM runs) UNPIVOT (value FOR metric IN ({', '.join(METRICS)}))"
_NORM = f""",
lg AS ({_LONG}),
nm AS (SELECT *, CASE WHEN value IS NULL THEN NULL
                      ELSE least(greatest(CASE WHEN max(value) OVER w = min(value) OVER w THEN 0.0
                                               ELSE (value - min(value) OVER w) / (max(value) OVER w - min(value) OVER w) END, 0.0), 1.0) END AS norm
       FROM lg WINDOW w AS (PARTITION BY board, metric)),
cs AS (SELECT board, run_id, any_value(run_order) AS run_order,
              sum(CASE metric WHEN 'r2' THEN 1.0 WHEN 'rmse' THEN -1.0 WHEN 'mae' THEN -0.5 ELSE -0.2 END * norm)
                / sum(abs(CASE metric WHEN 'r2' THEN 1.0 WHEN 'rmse' THEN -1.0 WHEN 'mae' THEN -0.5 ELSE -0.2 END)) FILTER (WHERE norm IS NOT NULL) AS composite
       FROM nm GROUP BY board, run_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY board ORDER BY composite DESC NULLS LAST, run_order) AS rank FROM cs)
"""


@register("normalize_minmax", Q(["runs"], _NORM + "SELECT board, run_id, metric, value, norm FROM nm", "value", "norm"))
def q_norm(spark, sf_dir):
    """Per-board min-max normalisation of each metric."""
    return J.normalize_minmax(J.metrics_long(runs(spark, sf_dir), METRICS)).select("board", "run_id", "metric", "value", "norm")


@register("normalize_robust", Q(["runs"], f""",
lg AS ({_LONG}),
q AS (SELECT board, metric, quantile_cont(value, 0.1) AS lo, quantile_cont(value, 0.9) AS hi FROM lg GROUP BY ALL)
SELECT board, run_id, metric, value, CASE WHEN value IS NULL THEN NULL
       ELSE least(greatest(CASE WHEN hi = lo THEN 0.0 ELSE (value - lo) / (hi - lo) END, 0.0), 1.0) END AS norm
FROM lg JOIN q USING (board, metric)""", "value", "norm"))
def q_norm_robust(spark, sf_dir):
    """Per-board 10 % / 90 % quantile normalisation."""
    return J.normalize_robust(J.metrics_long(runs(spark, sf_dir), METRICS)).select("board", "run_id", "metric", "value", "norm")


def _ranked(spark, sf_dir):
    r = runs(spark, sf_dir)
    comp = J.composite_score(J.normalize_minmax(J.metrics_long(r, METRICS)))
    return J.leaderboard_rank(comp)


@register("composite_score", Q(["runs"], _NORM + "SELECT board, run_id, run_order, composite FROM cs", "composite"))
def q_composite(spark, sf_dir):
    """Weighted composite (r2 +1, rmse -1, mae -0.5, mse -0.2)."""
    r = runs(spark, sf_dir)
    return J.composite_score(J.normalize_minmax(J.metrics_long(r, METRICS)))


@register("leaderboard_rank", Q(["runs"], _NORM + "SELECT board, run_id, run_order, composite, rank FROM rk", "composite"))
def q_rank(spark, sf_dir):
    """Rank per board by composite (NULLs last, ties by run order)."""
    return _ranked(spark, sf_dir)


@register("leaderboard_rank_fallback", Q(["runs"], _NORM + """,
x AS (SELECT cs.board, cs.run_id, cs.run_order, CASE WHEN cs.board % 3 = 0 THEN NULL ELSE composite END AS composite, rmse,
             CASE WHEN cs.board % 2 = 0 THEN 'maximize' ELSE 'minimize' END AS direction FROM cs JOIN runs r USING (board, run_id)),
y AS (SELECT *, count(composite) OVER (PARTITION BY board) > 0 AS has FROM x)
SELECT board, run_id, composite, row_number() OVER (PARTITION BY board ORDER BY CASE WHEN has THEN composite WHEN direction = 'maximize' THEN rmse ELSE -rmse END DESC NULLS LAST, run_order) AS rank,
       CASE WHEN has THEN 'composite' ELSE 'rmse' END AS ranked_by FROM y""", "composite"))
def q_rank_fallback(spark, sf_dir):
    """Boards without any composite (each third here) are ranked by their primary metric in its direction."""
    r = runs(spark, sf_dir)
    comp = J.composite_score(J.normalize_minmax(J.metrics_long(r, METRICS))).join(r.select("board", "run_id", "rmse"), ["board", "run_id"])
    comp = comp.withColumn("composite", F.when(F.col("board") % 3 != 0, F.col("composite"))).withColumn(
        "direction", F.when(F.col("board") % 2 == 0, "maximize").otherwise("minimize"))
    return J.leaderboard_rank(comp, primary_col="rmse").select("board", "run_id", "composite", "rank", "ranked_by")


@register("recommend_topk", Q(["runs"], _NORM + """
,f AS (SELECT rk.*, r.family, sum(CASE WHEN r.family = 'single' THEN 1 ELSE 0 END) OVER (PARTITION BY rk.board) AS singles
      FROM rk JOIN runs r USING (board, run_id)),
g AS (SELECT *, coalesce(abs(composite - max(composite) OVER (PARTITION BY board))
                  <= greatest(1e-12, 1e-9 * abs(max(composite) OVER (PARTITION BY board))), rank = 1) AS tie
      FROM f WHERE family = 'single' OR singles = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY board ORDER BY tie DESC, (family = 'single') DESC, rank) = 1 AS pick FROM g)
SELECT board, run_id, run_order, composite, rank, family, place,
       CASE WHEN place = 1 THEN 'recommended' ELSE 'top' || CAST(place AS VARCHAR) END AS tag
FROM (SELECT *, row_number() OVER (PARTITION BY board ORDER BY pick DESC, rank) AS place FROM p) WHERE place <= 3""", "composite"))
def q_topk(spark, sf_dir):
    """The filtered, tie-broken pick and the next ranked runs (k = 3)."""
    r = runs(spark, sf_dir)
    return J.recommend_topk(_ranked(spark, sf_dir).join(r.select("board", "run_id", "family"), ["board", "run_id"]), 3)


@register("recommend_tiebreak", Q(["runs"], _NORM + """,
f AS (SELECT rk.*, r.family, sum(CASE WHEN r.family = 'single' THEN 1 ELSE 0 END) OVER (PARTITION BY rk.board) AS singles
      FROM rk JOIN runs r USING (board, run_id)),
g AS (SELECT *, abs(composite - max(composite) OVER (PARTITION BY board))
                  <= greatest(1e-12, 1e-9 * abs(max(composite) OVER (PARTITION BY board))) AS tie
      FROM f WHERE family = 'single' OR singles = 0)
SELECT board, run_id, rank, tie FROM (
  SELECT *, row_number() OVER (PARTITION BY board ORDER BY tie DESC, (family = 'single') DESC, rank) AS pick FROM g) WHERE pick = 1"""))
def q_tiebreak(spark, sf_dir):
    """J9 + J10: ensembles filtered out, near-ties prefer a single model."""
    r = runs(spark, sf_dir)
    ranked = _ranked(spark, sf_dir).join(r.select("board", "run_id", "family"), ["board", "run_id"])
    return J.recommend_tiebreak(J.recommend_filter(ranked)).where("pick").select("board", "run_id", "rank", "tie")


@register("metric_pairs", Q(["runs"], _NORM + """
SELECT r.board, r.run_id, r2 AS x, rmse AS y, rank = 1 AS is_top FROM runs r JOIN rk USING (board, run_id)
WHERE r2 IS NOT NULL AND rmse IS NOT NULL AND NOT isnan(r2) AND NOT isnan(rmse) AND NOT isinf(r2) AND NOT isinf(rmse)""", "x", "y"))
def q_pairs(spark, sf_dir):
    """(r2, rmse) points with the winner flagged."""
    return J.metric_pairs(runs(spark, sf_dir), _ranked(spark, sf_dir))


def _two_preds(spark, sf_dir):
    r = reg(spark, sf_dir)
    qf = F.coalesce(F.col("quantity"), F.lit(25.0))
    lin = (F.lit(1.9) * qf - F.lit(20) * F.col("discount")
           + F.lit(1.5) * F.when(F.col("returnflag") == "R", 1.0).otherwise(0.0) + F.lit(1.0))
    return ({"m_lin": r.select("row_id", lin.alias("y_pred")), "m_qty": r.select("row_id", (F.lit(2) * qf).alias("y_pred"))}, r)


_TWO = """, tp AS (SELECT row_id, target,
  1.9::DOUBLE * coalesce(quantity, 25.0::DOUBLE) - 20 * discount + 1.5::DOUBLE * (CASE WHEN returnflag = 'R' THEN 1.0 ELSE 0.0 END)::DOUBLE + 1.0::DOUBLE AS a,
  2 * coalesce(quantity, 25.0::DOUBLE) AS b FROM reg)
"""


@register("ensemble_mean", Q(["reg"], _TWO + "SELECT row_id, (a + b) / 2 AS y_ens FROM tp", "y_ens"))
def q_ens_mean(spark, sf_dir):
    """Mean of two base predictors per row."""
    preds, _ = _two_preds(spark, sf_dir)
    return J.ensemble_mean(preds)


@register("ensemble_weighted", Q(["reg"], _TWO + """,
sc AS (SELECT 1.0 - sum((target - a) * (target - a)) / (var_pop(target) * count(*)) AS ra,
              1.0 - sum((target - b) * (target - b)) / (var_pop(target) * count(*)) AS rb FROM tp),
w AS (SELECT greatest(ra, 0.0) / (greatest(ra, 0.0) + greatest(rb, 0.0)) AS wa, greatest(rb, 0.0) / (greatest(ra, 0.0) + greatest(rb, 0.0)) AS wb FROM sc)
SELECT row_id, (SELECT wa FROM w) * a + (SELECT wb FROM w) * b AS y_ens FROM tp""", "y_ens"))
def q_ens_weighted(spark, sf_dir):
    """Weights proportional to each predictor's r2 (clipped at 0)."""
    from quarry.operators.evaluate import regression_metrics
    preds, r = _two_preds(spark, sf_dir)
    scores = None
    for name, d in preds.items():
        s = regression_metrics(d.join(r.select("row_id", F.col("target").alias("y_true")), "row_id")).select(
            F.lit(name).alias("model"), F.col("r2").alias("score"))
        scores = s if scores is None else scores.unionByName(s)
    return J.ensemble_weighted(preds, J.ensemble_weights(scores, "maximize"))


@register("ensemble_predict", Q(["pred_m"], f""",
b AS (SELECT row_id, p0, p1, p2, {sql_hash_unit(9, 'row_id')} % 3 AS v FROM pred_m),
a AS (SELECT row_id, (p0 + CASE WHEN v = 0 THEN 1.0 ELSE 0.0 END) / 2 AS q0, (p1 + CASE WHEN v = 1 THEN 1.0 ELSE 0.0 END) / 2 AS q1,
             (p2 + CASE WHEN v = 2 THEN 1.0 ELSE 0.0 END) / 2 AS q2 FROM b)
SELECT row_id, CAST(CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END AS BIGINT) AS y_pred FROM a"""))
def q_ens_predict(spark, sf_dir):
    """J20 + J21: average of the three-class probabilities and a one-hot vote model, argmax."""
    pm = pred_m(spark, sf_dir)
    votes = pm.select("row_id", J.onehot_votes(hash_bucket(9, "row_id", 3), 3).alias("proba"))
    return J.ensemble_predict({"pm": pm.select("row_id", "proba"), "votes": votes}, 3).select("row_id", "y_pred")


@register("model_comparison_rows", Q(["runs"], """
SELECT * REPLACE (CASE WHEN family = 'ensemble' THEN 'ensemble_mean' ELSE model END AS model),
       CASE WHEN family = 'ensemble' THEN 'ensemble' ELSE 'single' END AS family_label FROM runs""", "r2", "rmse", "mae", "mse"))
def q_model_rows(spark, sf_dir):
    """Single runs plus the ensemble runs labelled ensemble_mean."""
    r = runs(spark, sf_dir)
    return J.model_comparison_rows(r.where(F.col("family") == "single"), r.where(F.col("family") == "ensemble"))


# ------------------------------------------------------------------ I
_COEF = {"qf": 1.9, "discount": -20.0}


@register("score_regression", Q(["reg"], """
SELECT row_id, prediction, prediction - 2.5 AS pred_lower, prediction + 2.5 AS pred_upper
FROM (SELECT row_id, 1.0 + 1.9 * coalesce(quantity, 25.0::DOUBLE) + -20.0 * discount AS prediction FROM reg)""",
                                   "prediction", "pred_lower", "pred_upper"))
def q_score_reg(spark, sf_dir):
    """Fixed linear model with a conformal band of +-2.5 on every REG row."""
    r = reg(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0)))
    return I.score_regression(r, _COEF, 1.0, q=2.5)


@register("score_classification", Q(["cls"], """
SELECT row_id, 1.0 - p1 AS pred_proba_no, p1 AS pred_proba_yes, 0.5 AS threshold_used, CASE WHEN p1 >= 0.5 THEN 'yes' ELSE 'no' END AS pred_label
FROM (SELECT row_id, 1.0 / (1.0 + exp(-(-1.0 + 2e-06 * totalprice + 0.0001 * acctbal))) AS p1 FROM cls)""",
                                       "pred_proba_no", "pred_proba_yes", "threshold_used"))
def q_score_cls(spark, sf_dir):
    """I2 + I3: fixed logistic model, probability columns, threshold 0.5."""
    return I.score_binary(cls(spark, sf_dir), {"totalprice": 2e-06, "acctbal": 0.0001}, -1.0, ["no", "yes"], 0.5)


@register("topk_classes", Q(["pred_m"], """
SELECT row_id, l[1] AS top1_label, pr[1] AS top1_proba, l[2] AS top2_label, pr[2] AS top2_proba FROM (
  SELECT row_id, list_transform(s, lambda x: x.l) AS l, list_transform(s, lambda x: x.p) AS pr FROM (
    SELECT row_id, list_sort([{'p': p0, 'i': 0, 'l': 'F'}, {'p': p1, 'i': 1, 'l': 'O'}, {'p': p2, 'i': 2, 'l': 'P'}], 'DESC') AS s FROM pred_m))""",
                               "top1_proba", "top2_proba"))
def q_topk_classes(spark, sf_dir):
    """Two most probable order statuses per row."""
    pm = pred_m(spark, sf_dir)
    return pm.select("row_id", *I.topk_classes(F.col("proba"), ["F", "O", "P"], 2))


@register("decode_labels", Q(["pred_m"], """
SELECT row_id, y_pred, CASE y_pred WHEN 0 THEN 'F' WHEN 1 THEN 'O' ELSE 'P' END AS label FROM pred_m"""))
def q_decode(spark, sf_dir):
    """I4: predicted class index back to the status label."""
    _, classes = label_encode(cls(spark, sf_dir), "status")
    return I.decode_labels(pred_m(spark, sf_dir).select("row_id", "y_pred"), "y_pred", classes).select("row_id", "y_pred", "label")


@register("prediction_distribution", Q(["reg"], """,
w AS (SELECT 1.0 + 1.9 * coalesce(quantity, 25.0::DOUBLE) + -20.0 * discount AS width FROM reg),
rg AS (SELECT CASE WHEN min(width) = max(width) THEN min(width) - 0.5 ELSE min(width) END AS lo,
              CASE WHEN min(width) = max(width) THEN max(width) + 0.5 ELSE max(width) END AS hi FROM w)
SELECT bin, lo + bin * (hi - lo) / 20 AS lo, lo + (bin + 1) * (hi - lo) / 20 AS hi, count FROM (
  SELECT CAST(least(floor((width - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS count
  FROM w CROSS JOIN rg GROUP BY 1)""", "lo", "hi"))
def q_pred_dist(spark, sf_dir):
    """20-bin histogram of numeric predictions."""
    r = reg(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0)))
    return I.prediction_distribution(I.score_regression(r, _COEF, 1.0))
