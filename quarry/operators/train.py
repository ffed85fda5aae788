"""The train task as one program (G18): resampling or class weights on the train rows, a fitted and saved bundle with
threshold and conformal width, and what the validation rows say of it: predictions, report, interval, cross-validation."""

from __future__ import annotations

from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import bootstrap as B
from quarry.operators import bundle as BU
from quarry.operators import evaluate as H
from quarry.operators import models as G
from quarry.operators.scoring import sanitize_label
from quarry.operators.splits import apply_split, kfold_assign
from quarry.session import stored


class Trained(NamedTuple):
    path: str                # the saved bundle
    bundle: BU.Bundle
    predictions: DataFrame   # validation rows: row id, y_true, y_pred and, for classes, p or proba (class order)
    report: DataFrame
    interval: DataFrame      # bootstrap interval of the primary metric
    folds: DataFrame | None  # cross-validation on the train rows: linear and two-class models


def train_task(df: DataFrame, split: DataFrame, row_id: str, target: str, numeric: Sequence[str], categorical: Sequence[str], path: str,
               task: str = "regression", model: str = "ols", imbalance: str | None = None, conformal_alpha: float | None = None,
               threshold_metric: str | None = None, n_boot: int = 200, cv_folds: int = 0, seed: int = 42, **recipe) -> Trained:
    """``imbalance`` (classification): oversample, undersample or class_weight, on train rows only. ``recipe`` goes to
    :func:`quarry.operators.bundle.fit_bundle`. Rows without a target take no part."""
    if imbalance not in (None, "oversample", "undersample", "class_weight") or imbalance and task != "classification":
        raise ValueError(f"imbalance handling '{imbalance}' is not one for {task}")
    df = df.where(F.col(target).isNotNull())
    train, valid = apply_split(df, split, row_id, "train"), apply_split(df, split, row_id, "val")
    plain = train
    if imbalance == "class_weight":
        weights = G.class_weights(train, target).select(target, F.col("weight").alias("_weight"))
        train, recipe = train.join(F.broadcast(weights), target), recipe | {"weight_col": "_weight"}  # a row per class
    elif imbalance:
        train = getattr(G, imbalance)(train, target, row_id, seed)
    fitted = BU.fit_bundle(train, target, numeric, categorical, task, model, validation=valid, conformal_alpha=conformal_alpha,
                           threshold_metric=threshold_metric, seed=seed, **recipe)
    bundle = BU.load_bundle(df.sparkSession, BU.save_bundle(fitted, path))
    scored = bundle.score(valid, [row_id, target])
    if task == "regression":
        pred = stored(scored.select(row_id, F.col(target).alias("y_true"), F.col("prediction").alias("y_pred")))
        report, interval = H.metrics_report_regression(pred), H.bootstrap_ci(pred, "rmse", row_id, n_boot=n_boot, seed=seed)
    else:
        labels = bundle.spec["labels"]
        proba = [F.col(f"pred_proba_{sanitize_label(l)}") for l in labels]
        index = F.create_map(*[x for i, l in enumerate(labels) for x in (F.lit(l), F.lit(i))])
        own = F.element_at(index, F.col(target).cast("string"))  # a label that train never had is none
        pred = stored(scored.select(row_id, F.col(target).cast("string").alias("y_true"), F.col("pred_label").alias("y_pred"), own.alias("y_index"),
                                    *([proba[1].alias("p")] if len(labels) == 2 else [F.array(*proba).alias("proba")])))
        report = H.classification_report(pred)
        known = pred.where(F.col("y_index").isNotNull())
        interval = (B.bootstrap_ci_proba(known, "roc_auc", row_id, "y_index", "p", n_boot, seed=seed) if len(labels) == 2
                    else B.bootstrap_ci_multiclass(known, len(labels), ("roc_auc",), row_id, "y_index", "proba", n_boot, seed=seed))
    folds = None
    if cv_folds:
        ready, features = bundle.features(plain), bundle.spec["features"]
        parts = kfold_assign(plain, row_id, cv_folds, seed)
        if task == "regression" and model in BU.LINEAR:
            folds = G.cross_validate_linear(ready, parts, row_id, features, target, recipe.get("alpha", 1.0) if model == "ridge" else 0.0)
        elif task == "classification" and len(bundle.spec["labels"]) == 2:
            y = (F.col(target).cast("string") == bundle.spec["labels"][1]).cast("int")
            folds = G.cross_validate_logistic(ready.withColumn("_y", y), parts, row_id, features, "_y", cv_folds)
    return Trained(path, bundle, pred, report, interval, folds)
