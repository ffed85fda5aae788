"""Run comparison, ranking, recommendation and prediction ensembling.

A runs table has one row per training run (board, run_id, run_order, metric
columns, identity columns). Per-board windows are over runs, whose count per
board is bounded by the number of model configurations, not by data volume.
Ensembles combine prediction tables by ``row_id`` with a union + group-by (one
shuffle, map-side partial sums)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Default composite weights and required run fields.
DEFAULT_WEIGHTS = {"r2": 1.0, "rmse": -1.0, "mae": -0.5, "mse": -0.2}
REQUIRED = ["primary_metric", "direction", "dataset_id", "split_hash", "recipe_hash", "model", "best_score"]


# ------------------------------------------------------------------ J1
def runs_required_fields(runs: DataFrame, score_col: str = "r2") -> DataFrame:
    """Reason list of missing required fields; ``ok`` when none is missing."""
    r = runs.withColumn("best_score", F.col(score_col))
    reasons = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"missing_{c}")) for c in REQUIRED]))
    return r.select("board", "run_id", F.concat_ws(",", reasons).alias("reasons"), (F.size(reasons) == 0).alias("ok"))


# ------------------------------------------------------------------ J3
def runs_comparable(runs: DataFrame, keys: Sequence[str] = ("dataset_id", "split_hash", "primary_metric", "direction", "seed")) -> DataFrame:
    """Reference value per board = first non-null in run order; a run mismatches on a
    differing or missing value."""
    ref = runs.groupBy("board").agg(*[F.min_by(F.col(k), F.when(F.col(k).isNotNull(), F.col("run_order"))).alias(f"_ref_{k}")
                                      for k in keys])
    j = runs.join(ref, "board")
    reasons = F.array_compact(F.array(*[F.when(F.col(k).isNull() | (F.col(k) != F.col(f"_ref_{k}")), F.lit(f"{k}_mismatch"))
                                        for k in keys]))
    return j.select("board", "run_id", (F.size(reasons) == 0).alias("comparable"), F.concat_ws(",", reasons).alias("reasons"))


def metrics_long(runs: DataFrame, metrics: Sequence[str]) -> DataFrame:
    return runs.select("board", "run_id", "run_order", *metrics).unpivot(["board", "run_id", "run_order"], list(metrics), "metric", "value")


# ------------------------------------------------------------------ J5 / J6
def normalize_minmax(long: DataFrame) -> DataFrame:
    """(v - min) / (max - min) per (board, metric), clipped to [0, 1]; all equal -> 0."""
    w = Window.partitionBy("board", "metric")
    lo, hi = F.min("value").over(w), F.max("value").over(w)
    norm = F.when(hi == lo, F.lit(0.0)).otherwise((F.col("value") - lo) / (hi - lo))
    return long.withColumn("norm", F.when(F.col("value").isNull(), None).otherwise(F.least(F.greatest(norm, F.lit(0.0)), F.lit(1.0))))


def normalize_robust(long: DataFrame) -> DataFrame:
    """Same with the linear 10 % / 90 % quantiles per (board, metric)."""
    q = long.groupBy("board", "metric").agg(F.percentile("value", F.array(F.lit(0.1), F.lit(0.9))).alias("_q"))  # runs per board: bounded
    j = long.join(q, ["board", "metric"])
    lo, hi = F.col("_q")[0], F.col("_q")[1]
    norm = F.when(hi == lo, F.lit(0.0)).otherwise((F.col("value") - lo) / (hi - lo))
    return j.withColumn("norm", F.when(F.col("value").isNull(), None).otherwise(F.least(F.greatest(norm, F.lit(0.0)), F.lit(1.0)))).drop("_q")


# ------------------------------------------------------------------ J7
def composite_score(normed: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """sum(w * norm) / sum(|w|) over non-null metrics with w != 0; NULL if none."""
    wts = weights or DEFAULT_WEIGHTS
    wexpr = F.coalesce(*[F.when(F.col("metric") == m, F.lit(float(v))) for m, v in wts.items()], F.lit(0.0))
    x = normed.withColumn("_w", wexpr).where((F.col("_w") != 0) & F.col("norm").isNotNull())
    agg = x.groupBy("board", "run_id").agg((F.sum(F.col("_w") * F.col("norm")) / F.sum(F.abs("_w"))).alias("composite"))
    return normed.select("board", "run_id", "run_order").distinct().join(agg, ["board", "run_id"], "left")


# ------------------------------------------------------------------ J8
def leaderboard_rank(scored: DataFrame, score_col: str = "composite", descending: bool = True, primary_col: str | None = None,
                     direction_col: str = "direction") -> DataFrame:
    """1-based rank per board: score in its direction, NULLs last, ties by run order. With ``primary_col``, a board
    none of whose runs has a score is ranked by that metric in the board's direction (minimize unless it says
    maximize); ``ranked_by`` names the column that decided."""
    board = Window.partitionBy("board")
    if primary_col is None:
        o = F.col(score_col).desc_nulls_last() if descending else F.col(score_col).asc_nulls_last()
        return scored.withColumn("rank", F.row_number().over(board.orderBy(o, F.col("run_order"))).cast("bigint"))
    has = F.count(F.col(score_col)).over(board) > 0
    sign = F.when(F.lower(F.trim(direction_col)) == "maximize", 1.0).otherwise(-1.0)
    key = F.when(F.col("_has"), F.col(score_col) * (1.0 if descending else -1.0)).otherwise(F.col(primary_col) * sign)
    ranked = scored.withColumn("_has", has).withColumn("_key", key)
    rank = F.row_number().over(board.orderBy(F.col("_key").desc_nulls_last(), F.col("run_order"))).cast("bigint")
    by = F.when(F.col("_has"), F.lit(score_col)).otherwise(F.lit(primary_col))
    return ranked.withColumn("rank", rank).withColumn("ranked_by", by).drop("_has", "_key")


# ------------------------------------------------------------------ J9 / J10 / J11
def recommend_filter(ranked: DataFrame, family_col: str = "family", allow_ensemble: bool = False) -> DataFrame:
    """Drop ensembles unless allowed (only when a single model remains on the board)."""
    if allow_ensemble:
        return ranked
    singles = F.sum(F.when(F.col(family_col) == "single", 1).otherwise(0)).over(Window.partitionBy("board"))
    return ranked.withColumn("_singles", singles).where((F.col(family_col) == "single") | (F.col("_singles") == 0)).drop("_singles")


def recommend_tiebreak(ranked: DataFrame, score_col: str = "composite", family_col: str = "family",
                       rel: float = 1e-9, abs_tol: float = 1e-12) -> DataFrame:
    """Runs within rel/abs tolerance of the board's top score prefer a single model."""
    top = F.max(score_col).over(Window.partitionBy("board"))
    tie = F.abs(F.col(score_col) - top) <= F.greatest(F.lit(abs_tol), F.lit(rel) * F.abs(top))
    tie = F.coalesce(tie, F.col("rank") == 1)  # a board without scores keeps its first run
    w = Window.partitionBy("board").orderBy(tie.desc(), (F.col(family_col) == "single").desc(), F.col("rank"))
    return ranked.withColumn("tie", tie).withColumn("pick", F.row_number().over(w) == 1)


def recommend_source(ranked: DataFrame, source_col: str, priority: Sequence[str] = ("test", "valid", "train")) -> DataFrame:
    """Per board only the runs of the first metric source in ``priority`` that any run has;
    a null source counts as "valid"; boards with none of them keep all runs."""
    place = F.array_position(F.array(*map(F.lit, priority)), F.coalesce(F.col(source_col), F.lit("valid")))
    known = F.when(place > 0, place)
    best = F.min(known).over(Window.partitionBy("board"))
    return ranked.withColumn("_p", known).withColumn("_b", best).where(F.col("_b").isNull() | (F.col("_p") == F.col("_b"))).drop("_p", "_b")


def recommend_topk(ranked: DataFrame, k: int = 3, family_col: str = "family", allow_ensemble: bool = False,
                   source_col: str | None = None, score_col: str = "composite") -> DataFrame:
    """Up to k recommended runs per board: the tie-broken pick first, then the other
    candidates by rank. Candidates have passed the source priority (if ``source_col`` is
    given) and the ensemble filter. Adds ``place`` (1..k) and ``tag``."""
    c = ranked if source_col is None else recommend_source(ranked, source_col)
    c = recommend_tiebreak(recommend_filter(c, family_col, allow_ensemble), score_col, family_col)
    w = Window.partitionBy("board").orderBy(F.col("pick").desc(), "rank")
    c = c.withColumn("place", F.row_number().over(w).cast("bigint")).where(F.col("place") <= k).drop("tie", "pick")
    return c.withColumn("tag", F.when(F.col("place") == 1, F.lit("recommended")).otherwise(F.concat(F.lit("top"), F.col("place").cast("string"))))


# ------------------------------------------------------------------ J14
def metric_pairs(runs: DataFrame, ranked: DataFrame, x: str = "r2", y: str = "rmse") -> DataFrame:
    j = runs.join(ranked.select("board", "run_id", "rank"), ["board", "run_id"])
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != F.lit(float("inf")))
    return j.where(finite(x) & finite(y)).select("board", "run_id", F.col(x).alias("x"), F.col(y).alias("y"),
                                                   (F.col("rank") == 1).alias("is_top"))


# ------------------------------------------------------------------ J17 / J18 / J21
def ensemble_mean(preds: dict[str, DataFrame], row_id: str = "row_id", value: str = "y_pred") -> DataFrame:
    """Average of base predictions per row (union + group-by)."""
    u = None
    for name, d in preds.items():
        part = d.select(row_id, F.col(value).alias("_v"), F.lit(name).alias("model"))
        u = part if u is None else u.unionByName(part)
    return u.groupBy(row_id).agg(F.avg("_v").alias("y_ens"))


def ensemble_weights(scores: DataFrame, direction: str = "maximize") -> DataFrame:
    """(model, weight): proportional to score (maximize) or 1/max(|score|, 1e-12) (minimize);
    negatives clipped to 0; all zero -> uniform."""
    raw = F.greatest(F.col("score"), F.lit(0.0)) if direction == "maximize" else F.lit(1.0) / F.greatest(F.abs("score"), F.lit(1e-12))
    s = scores.withColumn("_r", raw)
    tot = F.sum("_r").over(Window.partitionBy(F.lit(1)))  # one row per model
    cnt = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    return s.select("model", F.when(tot > 0, F.col("_r") / tot).otherwise(F.lit(1.0) / cnt).alias("weight"))


def ensemble_weighted(preds: dict[str, DataFrame], weights: DataFrame, row_id: str = "row_id", value: str = "y_pred") -> DataFrame:
    u = None
    for name, d in preds.items():
        part = d.select(row_id, F.col(value).alias("_v"), F.lit(name).alias("model"))
        u = part if u is None else u.unionByName(part)
    return u.join(F.broadcast(weights), "model").groupBy(row_id).agg(F.sum(F.col("weight") * F.col("_v")).alias("y_ens"))


def ensemble_predict(probas: dict[str, DataFrame], n_classes: int, row_id: str = "row_id", proba: str = "proba") -> DataFrame:
    """Argmax of the averaged class probabilities (first maximum wins)."""
    u = None
    for name, d in probas.items():
        part = d.select(row_id, F.posexplode(proba).alias("cls", "_p"))
        u = part if u is None else u.unionByName(part)
    avg = u.groupBy(row_id, "cls").agg(F.avg("_p").alias("_p"))
    arr = avg.groupBy(row_id).agg(F.array_sort(F.collect_list(F.struct("cls", "_p"))).alias("_s"))  # n_classes per row
    probs = F.transform("_s", lambda s: s["_p"])
    return arr.select(row_id, probs.alias("proba"), (F.array_position(probs, F.array_max(probs)) - 1).alias("y_pred"))


def onehot_votes(pred: Column, n_classes: int) -> Column:
    """A class prediction as a one-hot probability vector (class clipped to range)."""
    c = F.least(F.greatest(pred, F.lit(0)), F.lit(n_classes - 1))
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: F.when(i == c, 1.0).otherwise(0.0))


# ------------------------------------------------------------------ J23
def model_comparison_rows(singles: DataFrame, ensembles: DataFrame, method: str = "mean") -> DataFrame:
    s = singles.withColumn("family_label", F.lit("single"))
    e = ensembles.withColumn("family_label", F.lit("ensemble")).withColumn("model", F.lit(f"ensemble_{method}"))
    return s.unionByName(e, allowMissingColumns=True)


# ------------------------------------------------------------------ J12
def metric_ci_columns(runs: DataFrame, ci_cols: Sequence[str] = ("primary_metric_ci", "metric_ci", "metrics_ci")) -> DataFrame:
    """low / mid / high from the first CI struct that has any value."""
    present = [c for c in ci_cols if c in runs.columns]
    usable = [F.when(F.col(c).isNotNull() & (F.col(c)["low"].isNotNull() | F.col(c)["mid"].isNotNull() | F.col(c)["high"].isNotNull()),
                     F.col(c)) for c in present]
    ci = F.coalesce(*usable) if usable else F.lit(None)
    return runs.select("board", "run_id", ci["low"].alias("ci_low"), ci["mid"].alias("ci_mid"), ci["high"].alias("ci_high"))


# ------------------------------------------------------------------ J13
def decision_summary(ranked: DataFrame, top: int = 5, **policy) -> DataFrame:
    """Top rows per board with the recommended run's id and score carried on each row; the
    recommendation is :func:`recommend_topk`'s first, with its ``policy``."""
    rec = recommend_topk(ranked, 1, **policy).select("board", F.col("run_id").alias("recommended_run"),
                                                  F.col("composite").alias("recommended_score"))
    return ranked.where(F.col("rank") <= top).join(rec, "board", "left")


# ------------------------------------------------------------------ J15 / J16
def ensemble_candidates(runs: DataFrame, preds: dict[str, DataFrame] | None = None, row_id: str = "row_id") -> DataFrame:
    """Skip reasons per run (missing fields, incomparable run, differing y_true);
    ``included`` when none apply. y_true is compared with the first model's by a
    full outer join on the row id (NULL-safe)."""
    req = runs_required_fields(runs).select("board", "run_id", F.col("reasons").alias("_r1"))
    cmp = runs_comparable(runs).select("board", "run_id", F.col("reasons").alias("_r2"))
    out = req.join(cmp, ["board", "run_id"])
    if preds:
        names = list(preds)
        ref = preds[names[0]].select(row_id, F.col("y_true").alias("_ref"))
        checks = []
        for n in names:
            j = ref.join(preds[n].select(row_id, "y_true"), row_id, "full_outer")
            checks.append(j.agg(F.bool_and(F.col("_ref").eqNullSafe(F.col("y_true")))).scalar().alias(f"_y_{n}"))
        same = out.select("*", *checks)
        ytrue = F.coalesce(*[F.when((F.col("model") == n) & ~F.col(f"_y_{n}"), F.lit("y_true_mismatch")) for n in names])
        out = same.join(runs.select("board", "run_id", "model"), ["board", "run_id"]).withColumn("_r3", ytrue)
    else:
        out = out.withColumn("_r3", F.lit(None).cast("string"))
    reasons = F.concat_ws(",", F.array_compact(F.array(F.nullif("_r1", F.lit("")), F.nullif("_r2", F.lit("")), F.col("_r3"))))
    return out.select("board", "run_id", reasons.alias("skip_reasons"), (reasons == "").alias("included"))


def ensemble_select_topk(candidates: DataFrame, runs: DataFrame, metric: str = "r2", k: int = 3, maximize: bool = True) -> DataFrame:
    """Included candidates sorted by the selection metric in its direction; k <= 0 keeps all."""
    j = candidates.where("included").join(runs.select("board", "run_id", "run_order", metric), ["board", "run_id"])
    o = F.col(metric).desc_nulls_last() if maximize else F.col(metric).asc_nulls_last()
    r = j.withColumn("sel_rank", F.row_number().over(Window.partitionBy("board").orderBy(o, "run_order")).cast("bigint"))
    return r if k <= 0 else r.where(F.col("sel_rank") <= k)


# ------------------------------------------------------------------ J19
def ensemble_stacking(preds: dict[str, DataFrame], target: DataFrame, row_id: str = "row_id", alpha: float = 1.0):
    """Ridge meta-model on the base predictions pivoted to columns (fitted on the rows
    it scores, as the reference does). Returns (coefficient table, stacked predictions)."""
    from quarry.operators.models import fit_linear_gram
    from quarry.operators.scoring import linear_expr
    wide = target
    for n, d in preds.items():
        wide = wide.join(d.select(row_id, F.col("y_pred").alias(n)), row_id)
    names = list(preds)
    w, b = fit_linear_gram(wide, names, "y_true", "ridge", alpha)
    coefs = dict(zip(names, [float(x) for x in w]))
    rows = [(f, c, abs(c)) for f, c in coefs.items()] + [("__intercept__", b, None)]
    table = wide.sparkSession.createDataFrame(rows, "feature string, coefficient double, importance double")
    return table, wide.select(row_id, "y_true", linear_expr(coefs, b).alias("y_stack"))


def ensemble_stacking_logistic(probas: dict[str, DataFrame], target: DataFrame, n_classes: int, row_id: str = "row_id", l2: float = 1.0):
    """Logistic meta-model on the concatenated base probabilities (``proba`` arrays in class order; of two classes
    only the second enters). ``target`` has ``y_true`` as class numbers. Returns (coefficient rows, stacked
    ``proba`` and ``y_pred``, the first of equal ones)."""
    from quarry.operators.models import logistic_proba, newton_logistic
    wide, feats = target, []
    for n, d in probas.items():
        classes = [1] if n_classes == 2 else range(n_classes)
        cols = [F.col("proba")[k].alias(f"{n}_{k}") for k in classes]
        feats += [f"{n}_{k}" for k in classes]
        wide = wide.join(d.select(row_id, *cols), row_id)
    coef = newton_logistic(wide, feats, "y_true", n_classes, l2)[0]
    rows = [(1 if len(coef) == 1 else k, f, float(v)) for k, row in enumerate(coef) for f, v in zip(["__intercept__", *feats], row)]
    table = wide.sparkSession.createDataFrame(rows, "class int, feature string, coefficient double")
    scored = wide.select(row_id, "y_true", F.array(*logistic_proba(coef, feats)).alias("proba"))
    return table, scored.withColumn("y_pred", (F.array_position("proba", F.array_max("proba")) - 1).cast("bigint"))


# ------------------------------------------------------------------ J22
def ensemble_report(preds: dict[str, DataFrame], ensemble: DataFrame, target: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Holdout regression metrics of each base model and of the ensemble (long table)."""
    from quarry.operators.evaluate import regression_metrics
    parts = []
    for n, d in list(preds.items()) + [("ensemble", ensemble.select(row_id, F.col("y_ens").alias("y_pred")))]:
        m = regression_metrics(d.join(target, row_id))
        parts.append(m.select(F.lit(n).alias("model"), "r2", "rmse", "mae", "mse"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
