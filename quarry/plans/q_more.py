"""Further scoring (I9-I11), leaderboard (J12-J22), model (G*, H15, H16, H21),
sink round-trip (A*), gate (D14) and streaming (L3-L5) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import HASH_RANGE, sql_hash_unit
from quarry.operators import bundle as BU
from quarry.operators import drift as K
from quarry.operators import evaluate as H
from quarry.operators import leaderboard as J
from quarry.operators import models as G
from quarry.operators import scoring as I
from quarry.operators import splits as E
from quarry.plans import sql_models as M
from quarry.plans.q_lead import _NORM, _TWO, _ranked, _two_preds
from quarry.plans.q_misc import CLS_FIT, FINGERPRINT_SQL, REG_FIT, RF as _RF, _reg_train_features, _table
from quarry.plans.q_prep import P_VAL, REG_SPLIT, REG_TRAIN, SEED, cls_rule, reg_rule, reg_split
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, pred_c, pred_m, reg, runs, table, with_views
from quarry.session import stored
from quarry.sources import io as A
from quarry.streaming import scoring as L


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


# ------------------------------------------------------------------ I9 / I10 / I11
@register("score_conditions", Q(["reg"], """
SELECT row_id, row_number() OVER (ORDER BY row_id) AS condition_id,
       CASE WHEN quantity IS NULL THEN 'failed' ELSE 'completed' END AS status,
       CASE WHEN quantity IS NULL THEN 'missing input: quantity' END AS error,
       CASE WHEN quantity IS NULL THEN NULL ELSE 1.0 + 1.9 * quantity + -20.0 * discount END AS prediction FROM reg""", "prediction"))
def q_conditions(spark, sf_dir):
    """One result per REG row with a per-row status instead of failing the batch."""
    r = reg(spark, sf_dir)
    return I.score_conditions(r, "row_id", ["quantity"], I.linear_expr({"quantity": 1.9, "discount": -20.0}, 1.0))


def _payload(spark, sf_dir):
    pm = pred_m(spark, sf_dir)
    top = F.slice(F.array_sort(F.array(*[F.struct(F.col(f"p{i}").alias("p"), F.lit(i).alias("i"), F.lit(l).alias("label"))
                                         for i, l in enumerate(["F", "O", "P"])]),
                               lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1)
                               .when(a["i"] > b["i"], -1).when(a["i"] < b["i"], 1).otherwise(0)), 1, 2)
    return pm.select("row_id",
                     F.create_map(F.lit("F"), "p0", F.lit("O"), "p1", F.lit("P"), "p2").alias("predicted_proba"),
                     F.transform(top, lambda s: F.struct(s["label"].alias("label"), s["p"].alias("proba"))).alias("top_k"),
                     F.array(F.col("y_pred").cast("double")).alias("prediction"))


@register("flatten_predictions", Q(["pred_m"], """
SELECT row_id, p0 AS pred_proba_F, p1 AS pred_proba_O, p2 AS pred_proba_P, l[1] AS top1_label, pr[1] AS top1_proba,
       l[2] AS top2_label, pr[2] AS top2_proba, y_pred::DOUBLE AS prediction FROM (
  SELECT row_id, p0, p1, p2, y_pred, list_transform(s, lambda x: x.l) AS l, list_transform(s, lambda x: x.p) AS pr FROM (
    SELECT *, list_sort([{'p': p0, 'i': 0, 'l': 'F'}, {'p': p1, 'i': 1, 'l': 'O'}, {'p': p2, 'i': 2, 'l': 'P'}], 'DESC') AS s FROM pred_m))""",
                                         "pred_proba_F", "pred_proba_O", "pred_proba_P", "top1_proba", "top2_proba", "prediction"))
def q_flatten(spark, sf_dir):
    """Probability map, top-k list and prediction array flattened to columns."""
    return I.flatten_predictions(_payload(spark, sf_dir), ["row_id"], proba_map="predicted_proba", topk="top_k",
                                 prediction_array="prediction")


_SPACE = {"quantity": {"type": "int", "low": 1, "high": 50}, "discount": {"type": "float", "low": 0.0, "high": 0.1, "step": 0.01}}


@register("input_search", Q(["reg"], f"""
SELECT row_id, quantity, discount, objective FROM (
  SELECT row_id, quantity, discount, 1.0 + 1.9 * quantity + -20.0 * discount + 1.5 * (CASE WHEN returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS objective FROM (
    SELECT row_id, returnflag,
           CAST(1.0 + least(floor({sql_hash_unit(0, 'row_id')} / {HASH_RANGE}::DOUBLE * 50.0), 49.0) AS BIGINT) AS quantity,
           0.0 + least(floor({sql_hash_unit(1, 'row_id')} / {HASH_RANGE}::DOUBLE * 11), 10) * 0.01 AS discount FROM reg))
ORDER BY objective DESC, row_id LIMIT 5""", "discount", "objective"))
def q_input_search(spark, sf_dir):
    """Random search in one job, one trial per REG row; best 5 inputs of a fixed model."""
    r = reg(spark, sf_dir).select("row_id", "returnflag")
    obj = lambda d: (F.lit(1.0) + F.lit(1.9) * F.col("quantity") + F.lit(-20.0) * F.col("discount")
                     + F.lit(1.5) * F.when(F.col("returnflag") == "R", 1.0).otherwise(0.0))
    return I.input_search(r, "row_id", _SPACE, obj, k=5, seed=0)


# ------------------------------------------------------------------ J12 / J13 / J15 / J16 / J19 / J22
def _runs_ci(spark, sf_dir):
    r = runs(spark, sf_dir)
    return r.select("*",
                    F.when(F.col("model") != "m_const", F.struct((F.col("r2") - 0.05).alias("low"), F.col("r2").alias("mid"),
                                                                 (F.col("r2") + 0.05).alias("high"))).alias("primary_metric_ci"),
                    F.struct((F.col("rmse") * 0.9).alias("low"), F.col("rmse").alias("mid"), (F.col("rmse") * 1.1).alias("high")).alias("metric_ci"))


@register("metric_ci_columns", Q(["runs"], """
SELECT board, run_id, CASE WHEN model <> 'm_const' THEN r2 - 0.05 ELSE rmse * 0.9 END AS ci_low,
       CASE WHEN model <> 'm_const' THEN r2 ELSE rmse END AS ci_mid,
       CASE WHEN model <> 'm_const' THEN r2 + 0.05 ELSE rmse * 1.1 END AS ci_high FROM runs""", "ci_low", "ci_mid", "ci_high"))
def q_ci_cols(spark, sf_dir):
    """Low / mid / high from the first CI field that is present."""
    return J.metric_ci_columns(_runs_ci(spark, sf_dir))


@register("decision_summary", Q(["runs"], _NORM + """,
f AS (SELECT rk.*, r.family, sum(CASE WHEN r.family = 'single' THEN 1 ELSE 0 END) OVER (PARTITION BY rk.board) AS singles
      FROM rk JOIN runs r USING (board, run_id)),
g AS (SELECT *, coalesce(abs(composite - max(composite) OVER (PARTITION BY board))
                  <= greatest(1e-12, 1e-9 * abs(max(composite) OVER (PARTITION BY board))), rank = 1) AS tie
      FROM f WHERE family = 'single' OR singles = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY board ORDER BY tie DESC, (family = 'single') DESC, rank) = 1 AS pick FROM g)
SELECT r.board, r.run_id, r.run_order, r.composite, r.rank, f.family, w.run_id AS recommended_run, w.composite AS recommended_score
FROM rk r JOIN f USING (board, run_id) LEFT JOIN (SELECT * FROM p WHERE pick) w ON r.board = w.board WHERE r.rank <= 5""", "composite", "recommended_score"))
def q_decision(spark, sf_dir):
    """Top-5 rows per board with the recommendation."""
    r = runs(spark, sf_dir)
    return J.decision_summary(_ranked(spark, sf_dir).join(r.select("board", "run_id", "family"), ["board", "run_id"]), 5)


_KEYS = ["dataset_id", "split_hash", "primary_metric", "direction", "seed"]
_CAND = f""",
ref AS (SELECT board, {', '.join(f'arg_min({k}, run_order) FILTER (WHERE {k} IS NOT NULL) AS ref_{k}' for k in _KEYS)} FROM runs GROUP BY board),
cand AS (SELECT r.board, run_id, run_order, r2, concat_ws(',', {', '.join(f"CASE WHEN {k} IS NULL OR {k} <> ref_{k} THEN '{k}_mismatch' END" for k in _KEYS)}) AS skip_reasons
         FROM runs r JOIN ref USING (board))
"""


@register("ensemble_candidates", Q(["runs"], _CAND + "SELECT board, run_id, skip_reasons, skip_reasons = '' AS included FROM cand"))
def q_candidates(spark, sf_dir):
    """Skip reasons per run (fields, comparability, y_true of the base predictions)."""
    preds, r = _two_preds(spark, sf_dir)
    tgt = r.select("row_id", F.col("target").alias("y_true"))
    p = {k: v.join(tgt, "row_id") for k, v in preds.items()}
    return J.ensemble_candidates(runs(spark, sf_dir), p)


@register("ensemble_select_topk", Q(["runs"], _CAND + """
SELECT board, run_id, run_order, r2, sel_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY board ORDER BY r2 DESC NULLS LAST, run_order) AS sel_rank FROM cand WHERE skip_reasons = '')
WHERE sel_rank <= 3""", "r2"))
def q_select_topk(spark, sf_dir):
    """Best 3 included runs per board by r2."""
    r = runs(spark, sf_dir)
    return J.ensemble_select_topk(J.ensemble_candidates(r), r, "r2", 3).select("board", "run_id", "run_order", "r2", "sel_rank")


@register("ensemble_stacking", Q(["reg"], _TWO + ", " + M.gram("g", "tp", ["a", "b"], "target") + ",\n" + M.solved("s", "g", 2, ["my", "m0", "m1"], "1.0")
                                 + "\n" + M.coefficient_rows("s", ["m_lin", "m_qty"]), "coefficient", "importance"))
def q_stacking(spark, sf_dir):
    """Ridge meta-model over two base predictors (coefficient table)."""
    preds, r = _two_preds(spark, sf_dir)
    coef, _ = J.ensemble_stacking(preds, r.select("row_id", F.col("target").alias("y_true")))
    return coef


_STACK_P = f"""SELECT row_id, label, 0.35::DOUBLE * label + 0.65::DOUBLE * ({sql_hash_unit(7, 'row_id')} / {HASH_RANGE}::DOUBLE) AS f0,
       0.2::DOUBLE * label + 0.8::DOUBLE * ({sql_hash_unit(8, 'row_id')} / {HASH_RANGE}::DOUBLE) AS f1 FROM cls"""


@register("ensemble_stacking_logistic", Q(["cls"], f", tf AS ({_STACK_P}),\n" + M.logistic("w", "tf", ["f0", "f1"], "label", 1.0) + """
SELECT row_id, 1 / (1 + exp(-(b0 + b1 * f0 + b2 * f1))) AS p_stack, CAST(CASE WHEN b0 + b1 * f0 + b2 * f1 > 0 THEN 1 ELSE 0 END AS BIGINT) AS y_pred FROM tf, w""", "p_stack"))
def q_stacking_logit(spark, sf_dir):
    """J19 for classifiers: logistic meta-model on two predictors' probabilities."""
    from quarry.functions.hashing import hash_uniform
    c = cls(spark, sf_dir)
    def base(share, seed):
        p = F.lit(share) * F.col("label") + F.lit(1 - share) * hash_uniform(seed, "row_id")
        return c.select("row_id", F.array(F.lit(1.0) - p, p).alias("proba"))
    _, out = J.ensemble_stacking_logistic({"a": base(0.35, 7), "b": base(0.2, 8)}, c.select("row_id", F.col("label").alias("y_true")), 2)
    return out.select("row_id", F.col("proba")[1].alias("p_stack"), "y_pred")


@register("ensemble_report", Q(["reg"], _TWO + """,
m AS (SELECT 'm_lin' AS model, target AS y, a AS p FROM tp UNION ALL SELECT 'm_qty', target, b FROM tp
      UNION ALL SELECT 'ensemble', target, (a + b) / 2 FROM tp)
SELECT model, 1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - p) * (y - p))) AS rmse,
       avg(abs(y - p)) AS mae, avg((y - p) * (y - p)) AS mse FROM m GROUP BY model""", "r2", "rmse", "mae", "mse"))
def q_ens_report(spark, sf_dir):
    """Holdout metrics of the base models and their mean ensemble."""
    preds, r = _two_preds(spark, sf_dir)
    return J.ensemble_report(preds, J.ensemble_mean(preds), r.select("row_id", F.col("target").alias("y_true")))


# ------------------------------------------------------------------ G / H15 / H16 / H21
def _reg_feats(spark, sf_dir):
    return reg(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0))).withColumn(
        "is_r", F.when(F.col("returnflag") == "R", 1.0).otherwise(0.0))


_FOLD = f"{sql_hash_unit(42, 'row_id')} % 5"


@register("cross_validate", Q(["reg"], REG_FIT + f"""kf AS (SELECT f.fold, tf.* FROM tf JOIN (SELECT unnest(range(5)) AS fold) f ON {_FOLD} <> f.fold),
""" + M.gram("g", "kf", _RF, "target", "fold") + ",\n" + M.solved("s", "g", 3, ["fold", "my", "m0", "m1", "m2"]) + f""",
o AS (SELECT s.fold::BIGINT AS fold, target AS y, {M.intercept(3)} + b0 * qf + b1 * discount + b2 * is_r AS p FROM tf JOIN s ON {_FOLD} = s.fold),
m AS (SELECT fold, count(*) AS n, sqrt(avg((y - p) * (y - p))) AS rmse, 1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM o GROUP BY fold)
SELECT * FROM m UNION ALL SELECT -1, NULL, avg(rmse), avg(r2) FROM m UNION ALL SELECT -2, NULL, stddev_pop(rmse), stddev_pop(r2) FROM m""", "rmse", "r2"))
def q_cv(spark, sf_dir):
    """5-fold OLS on the train rows from fold Gram sums (per-fold RMSE / R2, then mean and std)."""
    r = _reg_train_features(spark, sf_dir)
    return G.cross_validate_linear(r, E.kfold_assign(r, "row_id", 5, 42), "row_id", _RF, "target")


_ALPHAS = [0.0, 0.1, 1.0, 10.0, 100.0, 1000.0]


@register("grid_search", Q(["reg"], REG_FIT + """vf AS (SELECT *, coalesce(quantity, 25.0::DOUBLE) AS qf, CASE WHEN returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_r
        FROM reg WHERE row_id IN (SELECT row_id FROM sp WHERE split = 'val')),
""" + M.gram("g0", "tf", _RF, "target") + f""",
g AS (SELECT * FROM g0, (VALUES {', '.join(f'({i}::BIGINT, {a}::DOUBLE)' for i, a in enumerate(_ALPHAS))}) v(trial_id, alpha)),
""" + M.solved("s", "g", 3, ["trial_id", "alpha", "my", "m0", "m1", "m2"], "alpha") + f""",
o AS (SELECT trial_id, alpha, target AS y, {M.intercept(3)} + b0 * qf + b1 * discount + b2 * is_r AS p FROM vf, s),
m AS (SELECT trial_id, alpha, sqrt(avg((y - p) * (y - p))) AS rmse, 1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2 FROM o GROUP BY trial_id, alpha)
SELECT *, row_number() OVER (ORDER BY rmse, trial_id) = 1 AS best FROM m""", "alpha", "rmse", "r2"))
def q_grid(spark, sf_dir):
    """Ridge alphas solved from one train Gram and scored on validation."""
    r = _reg_feats(spark, sf_dir)
    sp = reg_rule(spark, sf_dir)
    return G.grid_search_ridge(E.apply_split(r, sp, "row_id", "train"), E.apply_split(r, sp, "row_id", "val"), _RF, "target", _ALPHAS)


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("fit_lasso", _recursive(Q(["reg"], REG_FIT + M.gram("g", "tf", _RF, "target") + ",\n" + M.elastic_net("s", "g", 3, 1.0, 0.0) + "\n" + M.coefficient_rows("s", _RF),
                                    "coefficient", "importance")))
def q_lasso(spark, sf_dir):
    """Lasso (alpha = 1) by coordinate descent on Gram sums."""
    return _table(spark, G.fit_linear_gram(_reg_train_features(spark, sf_dir), _RF, "target", "lasso", 1.0), _RF)


@register("fit_elasticnet", _recursive(Q(["reg"], REG_FIT + M.gram("g", "tf", _RF, "target") + ",\n" + M.elastic_net("s", "g", 3, 0.5, 0.5) + "\n" + M.coefficient_rows("s", _RF),
                                         "coefficient", "importance")))
def q_enet(spark, sf_dir):
    """Elastic net (alpha = 1, half of it L1) by coordinate descent on Gram sums."""
    return _table(spark, G.fit_linear_gram(_reg_train_features(spark, sf_dir), _RF, "target", "elasticnet", 1.0, 0.5), _RF)


_CF = ["totalprice", "acctbal", "nationkey"]


def _cls_eval(spark, sf_dir, kind):
    from quarry.operators.preprocess import apply_scale, fit_scale
    c = stored(cls(spark, sf_dir).select("row_id", "label", *_CF, F.col("label").cast("double").alias("y")))  # the join once
    sp = E.random_rule(c, "row_id", P_VAL, SEED)
    # standard-scaled numerics (fitted on train), as the reference's preprocessing does
    sc = fit_scale(E.apply_split(c, sp, "row_id", "train"), _CF, "standard")
    c = apply_scale(c, sc)
    tr, va = E.apply_split(c, sp, "row_id", "train"), E.apply_split(c, sp, "row_id", "val")
    m = G.fit_classifier(tr, _CF, "y", kind)
    pred = m.transform(G.assemble(va, _CF)).select("row_id", F.col("label").alias("y_true"), F.col("prediction").cast("bigint").alias("y_pred"))
    return m, H.classification_metrics(pred).select(F.lit(kind).alias("model"), "accuracy", "f_binary", "balanced_accuracy")


for _k in ("random_forest", "gradient_boosting", "mlp", "linear_svc"):
    def _mk(kind):
        @register(f"fit_{kind}")
        def _q(spark, sf_dir):
            return _cls_eval(spark, sf_dir, kind)[1]
        _q.__doc__ = f"G7-G11: {kind} fitted on CLS train rows, scored on validation."
    _mk(_k)


@register("feature_importance")
def q_importance(spark, sf_dir):
    """Random-forest importances, descending."""
    m, _ = _cls_eval(spark, sf_dir, "random_forest")
    return G.feature_importance(m, _CF, spark)


@register("fit_ridge_classifier", Q(["cls"], CLS_FIT + "pm AS (SELECT *, CASE WHEN label = 1 THEN 1.0 ELSE -1.0 END::DOUBLE AS pm FROM cls WHERE row_id IN (SELECT row_id FROM csp WHERE split = 'train')),\n"
                                    + M.gram("g", "pm", ["totalprice", "acctbal", "nationkey"], "pm") + ",\n" + M.solved("s", "g", 3, ["my", "m0", "m1", "m2"], "1.0") + f""",
o AS (SELECT label AS y, CASE WHEN {M.intercept(3)} + b0 * totalprice + b1 * acctbal + b2 * nationkey >= 0 THEN 1 ELSE 0 END AS p
      FROM cls, s WHERE row_id IN (SELECT row_id FROM csp WHERE split = 'val')),
c AS (SELECT count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp, count(*) FILTER (WHERE y = 1 AND p = 0) AS fn,
             avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END) AS accuracy FROM o)
SELECT accuracy, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f_binary FROM c""", "accuracy", "f_binary"))
def q_ridge_cls(spark, sf_dir):
    """Ridge on a +-1 target; validation accuracy of the sign rule."""
    sp = cls_rule(spark, sf_dir)
    c = cls(spark, sf_dir)
    w, b = G.fit_ridge_classifier(E.apply_split(c, sp, "row_id", "train"), _CF, "label")
    va = E.apply_split(c, sp, "row_id", "val")
    score = I.linear_expr(dict(zip(_CF, [float(x) for x in w])), float(b))
    pred = va.select(F.col("label").alias("y_true"), F.when(score >= 0, 1).otherwise(0).cast("bigint").alias("y_pred"))
    return H.classification_metrics(pred).select("accuracy", "f_binary")


@register("calibrate_sigmoid", Q(["pred_c"], ", " + M.logistic("w", "pred_c", ["p"], "y_true", 0.0, 12) + """
SELECT row_id, p, 1 / (1 + exp(-(b0 + b1 * p))) AS p_cal FROM pred_c, w""", "p", "p_cal"))
def q_platt(spark, sf_dir):
    """Platt scaling of the binary scores; calibrated probabilities per row."""
    pc = pred_c(spark, sf_dir)
    return G.apply_sigmoid(pc, G.calibrate_sigmoid(pc, "p", "y_true"), "p").select("row_id", "p", "p_cal")


@register("calibrate_isotonic")
def q_isotonic(spark, sf_dir):
    """Isotonic calibration of the binary scores."""
    pc = pred_c(spark, sf_dir).withColumn("y", F.col("y_true").cast("double"))
    m = G.calibrate_isotonic(pc, "p", "y")
    return G.apply_calibration(m, pc, "p").select("row_id", "p", "p_cal")


@register("train_model")
def q_train_model(spark, sf_dir):
    """Preprocess (fit on train) -> OLS -> validation metrics report, one program."""
    from quarry.operators.preprocess import preprocess_fit_transform
    r = reg(spark, sf_dir)
    sp = reg_rule(spark, sf_dir)
    proc = preprocess_fit_transform(r, sp, "row_id", ["quantity", "discount", "tax"], ["returnflag", "linestatus"], "target")
    feats = [c for c in proc.columns if c.startswith("num__") or c.startswith("cat__")]
    tr, va = E.apply_split(proc, sp, "row_id", "train"), E.apply_split(proc, sp, "row_id", "val")
    m = G.fit_linear(tr, feats, "target", "ols")
    pred = m.transform(G.assemble(va, feats)).select("row_id", F.col("target").alias("y_true"), F.col("prediction").alias("y_pred"))
    return H.metrics_report_regression(pred)


# ------------------------------------------------------------------ A round trips
@register("sink_processed", Q(["reg"], REG_SPLIT + "SELECT split, count(*) AS rows FROM sp GROUP BY split"))
def q_sink_processed(spark, sf_dir):
    """A10: processed rows written partitioned by split and read back (rows per split)."""
    path = A.shared_scratch(spark, "processed")
    r = reg(spark, sf_dir).select("row_id", "quantity", "target").join(reg_split(spark, sf_dir), "row_id")
    A.sink(r, path, "parquet", partition_by=["split"])
    return spark.read.parquet(path).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@register("sink_preds_valid", Q(["pred_m"], "SELECT row_id, y_true, y_pred, p0 AS proba__F, p1 AS proba__O, p2 AS proba__P FROM pred_m",
                                   "proba__F", "proba__O", "proba__P"))
def q_sink_preds(spark, sf_dir):
    """A14 + A15: validation predictions with proba__<label> columns, written and loaded back."""
    path = A.shared_scratch(spark, "preds")
    pm = pred_m(spark, sf_dir).select("row_id", "y_true", "y_pred", "proba")
    A.sink(A.proba_columns(pm, "proba", ["F", "O", "P"]), path)
    back = A.load_preds(spark.read.parquet(path), ["F", "O", "P"])
    return back.drop("proba")


@register("sink_leaderboard", Q(["runs"], _NORM + "SELECT board, run_id, rank, composite FROM rk", "composite"))
def q_sink_board(spark, sf_dir):
    """Ranked rows written as CSV in rank order and read back."""
    path = A.shared_scratch(spark, "board")
    A.sink(_ranked(spark, sf_dir).select("board", "run_id", "rank", "composite").orderBy("board", "rank"), path, "csv")
    return A.scan_csv(spark, path, "board bigint, run_id string, rank bigint, composite double")


@register("processed_dataset_id", Q(["reg"], REG_SPLIT + f""",
sh AS (SELECT CAST(count(*) AS VARCHAR) || ':' || CAST(sum(('0x' || substr(md5(concat_ws(chr(31), row_id, split)), 1, 15))::HUGEINT) AS VARCHAR) AS k FROM sp),
rh AS (SELECT fingerprint FROM ({FINGERPRINT_SQL}))
SELECT sha256('{{"raw":"' || (SELECT fingerprint FROM rh) || '","recipe":"recipe1","split":"' || sha256((SELECT k FROM sh)) || '"}}') AS processed_dataset_id"""))
def q_pid(spark, sf_dir):
    """Id of (raw table fingerprint, recipe hash, split fingerprint)."""
    return A.processed_dataset_id(A.table_fingerprint(table(spark, sf_dir, "lineitem")), A.table_fingerprint(reg_split(spark, sf_dir)), "recipe1")


@register("dataset_register")
def q_register(spark, sf_dir):
    """Scan -> fingerprint -> schema -> quality gate, one summary row."""
    from quarry.operators.quality import dq_gate
    from quarry.operators.schema import infer_schema
    li = table(spark, sf_dir, "lineitem")
    fp = A.table_fingerprint(li)
    sch = infer_schema(li)
    status, reasons = dq_gate(li, "warn", target="l_extendedprice", ids=["l_orderkey"])
    return fp.select("rows", "fingerprint", sch.agg(F.count(F.lit(1))).scalar().alias("columns"),
                     sch.agg(F.sum("null_count")).scalar().alias("missing_total"),
                     F.lit(status).alias("quality_status"), F.lit(",".join(reasons)).alias("fail_reasons"))


from quarry.plans.q_quality import _RULES  # noqa: E402


@register("dq_gate", with_views("leak") + _RULES + """
SELECT 'warn' AS mode, CASE WHEN count(*) FILTER (WHERE severity = 'fail') > 0 THEN 'fail'
                            WHEN count(*) > 0 THEN 'warn' ELSE 'pass' END AS status,
       coalesce(string_agg(CASE WHEN count <= 1 THEN type ELSE type || '(' || CAST(count AS VARCHAR) || ')' END, ',')
                FILTER (WHERE severity = 'fail'), '') AS reasons FROM rules""")
def q_gate(spark, sf_dir):
    """Gate outcome in warn mode for LEAK (fail reasons listed, job not aborted)."""
    from quarry.operators.quality import dq_gate
    from quarry.plans.views import leak
    status, reasons = dq_gate(leak(spark, sf_dir), "warn", target="target", ids=["record_id"])
    return spark.createDataFrame([("warn", status, ",".join(reasons))], "mode string, status string, reasons string")


# ------------------------------------------------------------------ L3 / L4 / L5
from quarry.plans.q_misc import _QUARTER, _over_event_batches  # noqa: E402
from quarry.session import scratch_path  # noqa: E402


@register("stream_sample", f"SELECT event_id, value FROM events ORDER BY {sql_hash_unit(0, 'event_id')}, event_id LIMIT 500")
def q_stream_sample(spark, sf_dir):
    """L3: bounded uniform sample carried across micro-batches (bottom-500 by hash)."""
    state = scratch_path(spark, "stream-sample")
    return _over_event_batches(spark, sf_dir, lambda s: L.stream_sample(s.select("event_id", "value"), "event_id", 500, state))


from quarry.plans.q_drift import numeric_drift_sql  # noqa: E402


@register("stream_drift", rnd("WITH _x AS (SELECT 1)" + numeric_drift_sql(
    "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16'", "SELECT * FROM events", ["value"]) + "SELECT * FROM ndrift",
    "psi", "ks"))
def q_stream_drift(spark, sf_dir):
    """L4: drift of streamed event values against the first half of January (train edges)."""
    ev = table(spark, sf_dir, "events")
    train = ev.where(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'"))
    state, edges = scratch_path(spark, "stream-drift"), K.hist_edges(train, ["value"])
    return _over_event_batches(spark, sf_dir, lambda s: L.stream_drift(s, train, ["value"], state, edges))


_EV = ["event_id", "user_id", "event_type", "value", "props"]
_EV_CARD = " UNION ALL ".join(
    f"SELECT '{c}' AS c, count(DISTINCT CAST({c} AS VARCHAR)) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS u, count(*) AS n, "
    f"count(*) - count({c}) AS nulls FROM ev" for c in _EV)
_EV_MATCH = " UNION ALL ".join(
    f"SELECT avg(CASE WHEN CAST({c} AS DOUBLE) IS NOT DISTINCT FROM value THEN 1.0 ELSE 0.0 END) AS r, FALSE AS exact FROM ev"
    for c in ["event_id", "user_id"])
_EV_CORR = " UNION ALL ".join(f"SELECT corr({c}, value) AS corr, count({c} + value) AS k FROM ev" for c in ["event_id", "user_id"])
_EV_RULES = f"""WITH ev AS (SELECT {', '.join(_EV)} FROM events WHERE {_QUARTER} = 0),
card AS ({_EV_CARD}),
tot AS (SELECT sum(nulls)::DOUBLE / (max(n) * {len(_EV)}) AS mr FROM card),
dup AS (SELECT sum(k - 1) AS d, sum(k - 1)::DOUBLE / sum(k) AS dr FROM (SELECT count(*) AS k FROM ev GROUP BY {', '.join(_EV)})),
mx AS (SELECT count(*) AS n FROM (SELECT feature FROM (
         SELECT feature, CASE WHEN lower(trim(v)) IN ('true', 'false') THEN 'bool' WHEN TRY_CAST(trim(v) AS DOUBLE) IS NOT NULL THEN 'number'
                              WHEN TRY_CAST(trim(v) AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'string' END AS b
         FROM (SELECT event_type, props FROM ev) UNPIVOT (v FOR feature IN (event_type, props)))
       GROUP BY feature HAVING count(DISTINCT b) > 1)),
hc AS (SELECT count(*) AS n, count(*) FILTER (WHERE u::DOUBLE / n >= 1.01) AS f FROM card
       WHERE c IN ('event_id', 'user_id', 'event_type', 'props') AND u >= 20 AND u::DOUBLE / n >= 0.8),
il AS (SELECT count(*) AS n, count(*) FILTER (WHERE u::DOUBLE / n >= 1.01) AS f FROM card WHERE c <> 'value' AND u >= 20 AND u::DOUBLE / n >= 0.98),
cn AS (SELECT count(*) AS n FROM card WHERE u <= 1),
nm AS (SELECT count(*) AS n FROM (SELECT unnest(['event_id', 'user_id', 'event_type', 'props']) AS c)
       WHERE c LIKE '%id%' OR c LIKE '%uuid%' OR c LIKE '%guid%' OR c LIKE '%target%' OR c LIKE '%label%'
          OR c LIKE '%outcome%' OR c LIKE '%response%' OR c LIKE '%value%'),
lk AS (SELECT 0 AS e, (SELECT count(*) FROM ({_EV_MATCH}) WHERE r >= 0.98)
                      + (SELECT count(*) FROM ({_EV_CORR}) WHERE k >= 2 AND corr IS NOT NULL AND NOT isnan(corr) AND abs(corr) >= 0.98) AS w),
rules0 AS (
  SELECT 'missing_rate' AS type, CASE WHEN mr >= 0.5 THEN 'fail' WHEN mr >= 0.2 THEN 'warn' END AS severity, CAST(1 AS BIGINT) AS count FROM tot
  UNION ALL SELECT 'duplicates', CASE WHEN dr >= 0.05 THEN 'fail' WHEN dr >= 0.01 THEN 'warn' END, CAST(CASE WHEN d > 0 THEN d ELSE 1 END AS BIGINT) FROM dup
  UNION ALL SELECT 'constant_columns', CASE WHEN n = 0 THEN NULL WHEN n >= 5 THEN 'fail' ELSE 'warn' END, n FROM cn
  UNION ALL SELECT 'mixed_type_columns', CASE WHEN n = 0 THEN NULL WHEN n >= 5 THEN 'fail' ELSE 'warn' END, n FROM mx
  UNION ALL SELECT 'high_cardinality', CASE WHEN n = 0 THEN NULL WHEN f > 0 OR n >= 9999 THEN 'fail' ELSE 'warn' END, n FROM hc
  UNION ALL SELECT 'id_like', CASE WHEN n = 0 THEN NULL WHEN f > 0 THEN 'fail' ELSE 'warn' END, n FROM il
  UNION ALL SELECT 'name_suspect', CASE WHEN n > 0 THEN 'warn' END, n FROM nm
  UNION ALL SELECT 'leak', CASE WHEN e > 0 THEN 'fail' END, e FROM lk
  UNION ALL SELECT 'leak', CASE WHEN w > 0 THEN 'warn' END, w FROM lk)
SELECT type, severity, CAST(count AS BIGINT) AS count FROM rules0 WHERE severity IS NOT NULL"""


@register("stream_quality_gate", _EV_RULES)
def q_stream_gate(spark, sf_dir):
    """Quality rules evaluated on the first micro-batch only."""
    state = scratch_path(spark, "stream-gate")
    return _over_event_batches(spark, sf_dir, lambda s: L.stream_quality_gate(s.drop("ts"), state, target="value"))


# ------------------------------------------------------------------ remaining inventory keys
@register("scan_chunked", Q(["reg"], """
SELECT CAST(floor(pos / 5000) AS BIGINT) AS chunk, min(pos) AS row_start, max(pos) + 1 AS row_end, count(*) AS rows
FROM (SELECT row_number() OVER (ORDER BY row_id) - 1 AS pos FROM reg) GROUP BY 1"""))
def q_chunks(spark, sf_dir):
    """5 000-row chunks in row-id order with their row offsets."""
    return A.chunk_ranges(reg(spark, sf_dir), "row_id", 5000)


_BUNDLE_SQL = REG_TRAIN + """,
m AS (SELECT avg(quantity) AS mq FROM tr),
it AS (SELECT *, coalesce(quantity, (SELECT mq FROM m)) AS q FROM tr),
st AS (SELECT avg(q) AS aq, coalesce(nullif(stddev_pop(q), 0), 1.0) AS sq, avg(discount) AS ad, coalesce(nullif(stddev_pop(discount), 0), 1.0) AS sd FROM it),
"""


@register("rebuild_processed", Q(["reg"], _BUNDLE_SQL + """fq AS (SELECT returnflag AS v, count(*)::DOUBLE / (SELECT count(*) FROM tr) AS f FROM tr GROUP BY 1),
od AS (SELECT linestatus AS v, row_number() OVER (ORDER BY linestatus) - 1 AS c FROM (SELECT DISTINCT linestatus FROM tr))
SELECT row_id, (coalesce(quantity, (SELECT mq FROM m)) - (SELECT aq FROM st)) / (SELECT sq FROM st) AS num__quantity,
       (discount - (SELECT ad FROM st)) / (SELECT sd FROM st) AS num__discount, coalesce(f, 0.0) AS cat__returnflag, coalesce(c::DOUBLE, -1.0) AS cat__linestatus
FROM reg LEFT JOIN fq ON returnflag = fq.v LEFT JOIN od ON linestatus = od.v""", "num__quantity", "num__discount", "cat__returnflag", "cat__linestatus"))
def q_rebuild(spark, sf_dir):
    """Imputer, scaler and two encoders fitted on the train rows, saved, loaded and re-applied to all raw rows."""
    r = reg(spark, sf_dir)
    tr = E.apply_split(r, reg_rule(spark, sf_dir), "row_id", "train")
    fitted = BU.fit_bundle(tr, "target", ["quantity", "discount"], ["returnflag", "linestatus"], encoding={"returnflag": "frequency", "linestatus": "ordinal"})
    back = BU.load_bundle(spark, BU.save_bundle(fitted, A.shared_scratch(spark, "bundle")))
    return back.features(r.select("row_id", "quantity", "discount", "returnflag", "linestatus")).select(
        "row_id", "num__quantity", "num__discount", "cat__returnflag", "cat__linestatus")


@register("score_bundle", Q(["reg"], _BUNDLE_SQL + """w AS (SELECT regr_slope(target, q) AS w, regr_intercept(target, q) AS b FROM it),
p AS (SELECT row_id, target, b + w * coalesce(quantity, (SELECT mq FROM m)) AS prediction FROM reg, w),
c AS (SELECT quantile_cont(abs(target - prediction), 0.9) AS q FROM p WHERE row_id IN (SELECT row_id FROM sp WHERE split = 'val'))
SELECT row_id, prediction, prediction - q AS pred_lower, prediction + q AS pred_upper FROM p, c""", "prediction", "pred_lower", "pred_upper"))
def q_score_bundle(spark, sf_dir):
    """I1 + G18: recipe, least squares and conformal width fitted, saved, loaded, and raw rows scored."""
    r, sp = reg(spark, sf_dir), reg_rule(spark, sf_dir)
    tr, va = E.apply_split(r, sp, "row_id", "train"), E.apply_split(r, sp, "row_id", "val")
    fitted = BU.fit_bundle(tr, "target", ["quantity"], validation=va, conformal_alpha=0.1)
    return BU.load_bundle(spark, BU.save_bundle(fitted, A.shared_scratch(spark, "bundle"))).score(r)


@register("sink_predictions", Q(["reg"], """
SELECT row_id, 1.0 + 1.9 * coalesce(quantity, 25.0::DOUBLE) + -20.0 * discount AS prediction FROM reg
UNION ALL
SELECT row_id, 1.0 + 1.9 * coalesce(quantity, 25.0::DOUBLE) + -20.0 * discount AS prediction FROM reg""", "prediction"))
def q_sink_predictions(spark, sf_dir):
    """Predictions written as CSV (overwrite), appended once more, read back."""
    r = reg(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0)))
    pred = I.score_regression(r, {"qf": 1.9, "discount": -20.0}, 1.0)
    path = A.shared_scratch(spark, "predictions")
    A.sink(pred, path, "csv", "overwrite")
    A.sink(pred, path, "csv", "append")
    return A.scan_csv(spark, path, "row_id string, prediction double")


@register("sink_errors", Q(["texty"], f""",
f AS (SELECT row_id, 'num_txt' AS "column", 'numeric_coerce_failed' AS reason FROM texty
        WHERE num_txt IS NOT NULL AND (TRY_CAST(trim(num_txt) AS DOUBLE) IS NULL OR isnan(TRY_CAST(trim(num_txt) AS DOUBLE))))
SELECT row_id, "column", reason FROM f"""))
def q_sink_errors(spark, sf_dir):
    """Coercion failures written as JSON issue records and read back."""
    from quarry.operators.schema import coerce_failures
    from quarry.plans.views import texty
    fails = coerce_failures(texty(spark, sf_dir), "row_id", {"num_txt": "double"})
    path = A.shared_scratch(spark, "errors")
    A.sink(fails, path, "json")
    return spark.read.schema("row_id string, column string, reason string").json(path)


@register("pos_weight", Q(["cls"], "SELECT count(*) FILTER (WHERE label <> 1)::DOUBLE / count(*) FILTER (WHERE label = 1) AS pos_weight FROM cls",
                          "pos_weight"))
def q_pos_weight(spark, sf_dir):
    """Negative / positive ratio of the binary CLS label."""
    return G.pos_weight(cls(spark, sf_dir), "label")


@register("apply_threshold", Q(["pred_c"], "SELECT row_id, CASE WHEN p >= 0.35 THEN 'F' ELSE 'not_F' END AS pred_label FROM pred_c"))
def q_apply_threshold(spark, sf_dir):
    """Stored threshold 0.35 applied to the positive-class score."""
    pc = pred_c(spark, sf_dir)
    return pc.select("row_id", I.apply_threshold(F.col("p"), 0.35, ["not_F", "F"]).alias("pred_label"))


@register("score_batch", Q(["texty"], """
SELECT row_id, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE 1.0 + 1.9 * v END AS prediction
FROM (SELECT row_id, TRY_CAST(trim(num_txt) AS DOUBLE) AS v FROM texty)""", "prediction"))
def q_score_batch(spark, sf_dir):
    """I8: validate (coerce mode) -> align -> predict over the whole TEXTY table in one lazy plan."""
    from pyspark.sql import types as T
    from quarry.operators.schema import validate_input
    from quarry.plans.views import texty
    expected = T.StructType([T.StructField("row_id", T.StringType()), T.StructField("num_txt", T.DoubleType())])
    aligned, _issues, _w, _e, _ok = validate_input(texty(spark, sf_dir), expected, "row_id", mode="coerce")
    return I.score_regression(aligned, {"num_txt": 1.9}, 1.0)


@register("recommend_filter", Q(["runs"], _NORM + """,
f AS (SELECT rk.*, r.family, sum(CASE WHEN r.family = 'single' THEN 1 ELSE 0 END) OVER (PARTITION BY rk.board) AS singles
      FROM rk JOIN runs r USING (board, run_id))
SELECT board, run_id, rank, family FROM f WHERE family = 'single' OR singles = 0"""))
def q_recommend_filter(spark, sf_dir):
    """Ensembles dropped from the recommendation while single models remain."""
    r = runs(spark, sf_dir)
    ranked = _ranked(spark, sf_dir).join(r.select("board", "run_id", "family"), ["board", "run_id"])
    return J.recommend_filter(ranked).select("board", "run_id", "rank", "family")


@register("ensemble_onehot_votes", Q(["pred_c"], """
SELECT row_id, CASE WHEN y_pred = 0 THEN 1.0 ELSE 0.0 END AS vote_0, CASE WHEN y_pred = 1 THEN 1.0 ELSE 0.0 END AS vote_1 FROM pred_c""",
                                       "vote_0", "vote_1"))
def q_onehot_votes(spark, sf_dir):
    """Class predictions as one-hot probability votes."""
    v = pred_c(spark, sf_dir).select("row_id", J.onehot_votes(F.col("y_pred"), 2).alias("v"))
    return v.select("row_id", F.col("v")[0].alias("vote_0"), F.col("v")[1].alias("vote_1"))
