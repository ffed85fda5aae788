"""Batch scoring (I1-I13): validate -> transform -> predict as one lazy projection.

Models are either MLlib ``PipelineModel``s (``model.transform``) or fixed
coefficient vectors (a linear / logistic expression), so scoring is a
row-local projection with no shuffle; top-k classes use array functions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.evaluate import equal_width_hist


def linear_expr(coefs: dict[str, float], intercept: float) -> Column:
    e = F.lit(float(intercept))
    for c, w in coefs.items():
        e = e + F.lit(float(w)) * F.col(c)
    return e


# ------------------------------------------------------------------ I1
def score_regression(df: DataFrame, coefs: dict[str, float], intercept: float, q: float | None = None,
                     keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """``prediction`` (+ ``pred_lower`` / ``pred_upper`` when a conformal q is given)."""
    out = df.select(*keep, linear_expr(coefs, intercept).alias("prediction"))
    if q is not None:
        out = out.withColumn("pred_lower", F.col("prediction") - F.lit(q)).withColumn("pred_upper", F.col("prediction") + F.lit(q))
    return out


# ------------------------------------------------------------------ I2 / I3 / I4
def score_binary(df: DataFrame, coefs: dict[str, float], intercept: float, labels: Sequence[str], threshold: float = 0.5,
                 keep: Sequence[str] = ("row_id",)) -> DataFrame:
    """Logistic score -> ``pred_proba_<label>`` columns, ``threshold_used`` and ``pred_label``."""
    p1 = F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_expr(coefs, intercept)))
    names = [sanitize_label(l) for l in labels]
    out = df.select(*keep, p1.alias("_p1"))
    return out.select(*keep, (F.lit(1.0) - F.col("_p1")).alias(f"pred_proba_{names[0]}"), F.col("_p1").alias(f"pred_proba_{names[1]}"),
                      F.lit(threshold).alias("threshold_used"),
                      apply_threshold(F.col("_p1"), threshold, labels).alias("pred_label"))


def apply_threshold(p1: Column, threshold: float, labels: Sequence[str]) -> Column:
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("threshold must be in [0, 1]")
    return F.when(p1 >= F.lit(threshold), F.lit(labels[1])).otherwise(F.lit(labels[0]))


def decode_labels(df: DataFrame, index_col: str, classes: DataFrame) -> DataFrame:
    """Class index -> label through the (small) class table."""
    from quarry.functions.ranking import bounded_broadcast
    return df.join(bounded_broadcast(classes.select(F.col("index").alias(index_col), F.col("cls").alias("label"))), index_col, "left")


def sanitize_label(label) -> str:
    import re
    return re.sub(r"[^0-9A-Za-z_]", "_", str(label))


# ------------------------------------------------------------------ I5
def topk_classes(proba: Column, labels: Sequence[str], k: int) -> list[Column]:
    """top{r}_label / top{r}_proba for r = 1..k from a probability array;
    equal probabilities put the higher class index first."""
    if k <= 1 or k > len(labels):
        raise ValueError("k must be in 2..n_classes")
    lab = F.array(*[F.lit(l) for l in labels])
    idx = F.sequence(F.lit(0), F.lit(len(labels) - 1))
    z = F.arrays_zip(proba.alias("p"), idx.alias("i"), lab.alias("l"))
    srt = F.array_sort(z, lambda a, b: F.when(a["p"] > b["p"], -1).when(a["p"] < b["p"], 1)
                       .when(a["i"] > b["i"], -1).when(a["i"] < b["i"], 1).otherwise(0))
    cols = []
    for r in range(k):
        cols += [srt[r]["l"].alias(f"top{r + 1}_label"), srt[r]["p"].alias(f"top{r + 1}_proba")]
    return cols


# ------------------------------------------------------------------ I13
def prediction_distribution(df: DataFrame, value: str = "prediction", bins: int = 20) -> DataFrame:
    return equal_width_hist(df, value, bins)


def label_counts(df: DataFrame, label: str = "pred_label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.col("count").desc(), F.col(label))


# ------------------------------------------------------------------ I9
def score_conditions(df: DataFrame, row_id: str, required: Sequence[str], prediction: Column) -> DataFrame:
    """One independent result per input row: condition_id 1..n (row-id order), status
    and error per row instead of failing the batch."""
    from quarry.functions.ranking import global_rank
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    out = df.select(row_id, prediction.alias("_p"), missing.alias("_miss"))
    ranked = global_rank(out, [row_id], "_r")
    bad = F.size("_miss") > 0
    return ranked.select(
        row_id, (F.col("_r") + 1).alias("condition_id"),
        F.when(bad, F.lit("failed")).otherwise(F.lit("completed")).alias("status"),
        F.when(bad, F.concat(F.lit("missing input: "), F.concat_ws(",", "_miss"))).alias("error"),
        F.when(bad, F.lit(None).cast("double")).otherwise(F.col("_p")).alias("prediction"))


# ------------------------------------------------------------------ I10
def flatten_predictions(df: DataFrame, keep: Sequence[str], proba_map: str | None = None, proba_array: str | None = None,
                        topk: str | None = None, prediction_array: str | None = None) -> DataFrame:
    """Payload columns to flat columns: map -> pred_proba_<label>, array -> pred_proba_<i>,
    top-k structs -> top{r}_label / top{r}_proba, prediction array -> prediction / prediction_<i>.
    The label set and array widths are read once (they are schema-sized)."""
    cols = [F.col(c) for c in keep]
    if proba_map:
        labels = sorted(r[0] for r in df.select(F.explode(F.map_keys(proba_map))).distinct().collect())
        cols += [F.col(proba_map)[l].alias(f"pred_proba_{sanitize_label(l)}") for l in labels]
    if proba_array:
        width = df.agg(F.max(F.size(proba_array))).first()[0] or 0
        cols += [F.try_element_at(proba_array, F.lit(i + 1)).alias(f"pred_proba_{i}") for i in range(width)]
    if topk:
        width = df.agg(F.max(F.size(topk))).first()[0] or 0
        for r in range(width):
            e = F.try_element_at(topk, F.lit(r + 1))
            cols += [e["label"].alias(f"top{r + 1}_label"), e["proba"].alias(f"top{r + 1}_proba")]
    if prediction_array:
        width = df.agg(F.max(F.size(prediction_array))).first()[0] or 0
        if width == 1:
            cols.append(F.col(prediction_array)[0].alias("prediction"))
        else:
            cols += [F.try_element_at(prediction_array, F.lit(i + 1)).alias(f"prediction_{i}") for i in range(width)]
    return df.select(*cols)


# ------------------------------------------------------------------ I11
def draw_param(u: Column, spec: dict) -> Column:
    """Map a uniform draw to a search-space value: float / int ranges (optional step,
    log scale) or categorical choices."""
    kind = spec.get("type", "float")
    if "choices" in spec or kind == "categorical":
        ch = spec["choices"]
        return F.element_at(F.array(*[F.lit(c) for c in ch]), (F.floor(u * len(ch)) + 1).cast("int"))
    lo, hi = float(spec["low"]), float(spec["high"])
    if spec.get("log"):
        import math
        v = F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))
    elif spec.get("step"):
        st = float(spec["step"])
        n = int(round((hi - lo) / st)) + 1
        v = F.lit(lo) + F.least(F.floor(u * n), F.lit(n - 1)) * F.lit(st)
    elif kind == "int":
        v = F.lit(lo) + F.least(F.floor(u * (hi - lo + 1)), F.lit(hi - lo))
    else:
        v = F.lit(lo) + u * F.lit(hi - lo)
    return v.cast("bigint") if kind == "int" else v


def input_search(trials: DataFrame, trial_id: str, space: dict[str, dict], objective, k: int = 5,
                 seed: int = 0, maximize: bool = True) -> DataFrame:
    """Random search in one job: every trial row draws each parameter from
    md5(seed+j : trial_id), overlays it on the row, scores ``objective(columns)``
    and the best k trials are kept (trials with a non-finite objective fail)."""
    from quarry.functions.hashing import hash_uniform
    drawn = trials.withColumns({name: draw_param(hash_uniform(seed + j, trial_id), spec)
                                for j, (name, spec) in enumerate(space.items())})
    scored = drawn.withColumn("objective", objective(drawn))
    value = F.col("objective").cast("double")
    ok = scored.where(value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf")))
    order = F.col("objective").desc() if maximize else F.col("objective").asc()
    return ok.orderBy(order, F.col(trial_id)).limit(k).select(trial_id, *space.keys(), "objective")
