"""Fitted bundles (A11, G18, I1, I2): everything a model needs to score raw rows, as files.

A bundle holds the imputation values, encoders, scaling constants, model, decision threshold and conformal
width that were fitted on train rows. Constants are one short Parquet table, encoder lookups another (as large
as the categories are many: they are joined, never collected), the model is a coefficient table or an MLlib
writer's folder. :func:`load_bundle` reads them in any session, and :meth:`Bundle.score` applies all of it to raw
rows as one lazy plan that fits nothing."""

from __future__ import annotations

import json
from typing import NamedTuple, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import MISSING_TOKEN
from quarry.operators import models as G
from quarry.operators import preprocess as P
from quarry.operators.evaluate import conformal_quantile, threshold_search
from quarry.operators.scoring import linear_expr, sanitize_label
from quarry.session import stored

LINEAR = ("ols", "ridge", "lasso", "elasticnet")
LOOKUPS = {"ordinal": ("code", -1.0), "frequency": ("freq", 0.0), "target_mean": ("enc", None)}


class Bundle(NamedTuple):
    spec: dict              # columns, encodings, task, labels, model kind, threshold, conformal q
    constants: DataFrame    # feature, fill, center, divisor, text: one row per input column
    lookups: DataFrame      # feature, value, code: encoder tables
    coefficients: DataFrame # model, feature, coefficient (linear models)
    fitted: object = None   # MLlib model (others)

    def features(self, df: DataFrame) -> DataFrame:
        """``df`` with ``num__`` and ``cat__`` columns (A11: the processed rows of this recipe)."""
        num, enc = self.spec["numeric"], self.spec["encodings"]
        st = {r.feature: r for r in self.constants.collect()}  # one row per input column
        out = df.withColumns({f"num__{c}": (F.coalesce(P._q(c).cast("double"), F.lit(st[c].fill)) - F.lit(st[c].center)) / F.lit(st[c].divisor) for c in num})
        as_text = {c: F.coalesce(P._q(c).cast("string"), F.lit(st[c].text)) for c in enc}
        out = out.withColumns({f"_txt_{c}": e for c, e in as_text.items()})
        for c, e in enc.items():
            if e == "onehot":
                out = P.apply_onehot(out, {f"_txt_{c}": self.spec["categories"][c]}, prefix="cat__")
                out = out.withColumnsRenamed({f"cat___txt_{c}_{v}": f"cat__{c}_{v}" for v in self.spec["categories"][c]})
            elif e == "hashing":
                out = out.drop(c).withColumnRenamed(f"_txt_{c}", c)
                out = P.apply_hashing(out, [c], self.spec["n_features"])
            else:
                default = LOOKUPS[e][1] if LOOKUPS[e][1] is not None else self.spec["target_mean"]
                own = self.lookups.where(F.col("feature") == c).withColumn("feature", F.lit(f"_txt_{c}"))
                out = P.apply_lookup(out, own, [f"_txt_{c}"], "code", default).withColumnRenamed(f"cat___txt_{c}", f"cat__{c}")
        return out.drop(*[f"_txt_{c}" for c in enc])

    def score(self, df: DataFrame, keep: Sequence[str] = ("row_id",)) -> DataFrame:
        """Regression: prediction, and pred_lower / pred_upper if the bundle has a conformal width. Classification:
        a pred_proba_<label> per label, pred_label and, for two labels, threshold_used."""
        out, kind = self.features(df), self.spec["model"]
        if kind in LINEAR:
            w = {r.feature: r.coefficient for r in self.coefficients.collect()}  # one row per feature
            out = out.select(*keep, linear_expr({f"`{f}`": w[f] for f in self.spec["features"]}, w["__intercept__"]).alias("prediction"))
        else:
            from pyspark.ml.functions import vector_to_array
            names = [f"_f{i}" for i in range(len(self.spec["features"]))]  # MLlib's assembler reads dots in names as fields
            out = out.select(*keep, *[P._q(f).alias(n) for f, n in zip(self.spec["features"], names)])
            out = self.fitted.transform(G.assemble(out, names))
            if self.spec["task"] == "regression":
                out = out.select(*keep, "prediction")
            else:
                out = out.select(*keep, vector_to_array("probability").alias("_p"))
        q = self.spec.get("conformal_q")
        if self.spec["task"] == "regression":
            return out if q is None else out.withColumns({"pred_lower": F.col("prediction") - F.lit(q), "pred_upper": F.col("prediction") + F.lit(q)})
        labels = self.spec["labels"]
        proba = [F.col("_p")[i].alias(f"pred_proba_{sanitize_label(l)}") for i, l in enumerate(labels)]
        if len(labels) == 2:
            t = self.spec.get("threshold") if self.spec.get("threshold") is not None else 0.5
            best = F.when(F.col("_p")[1] >= F.lit(t), F.lit(labels[1])).otherwise(F.lit(labels[0]))
            return out.select(*keep, *proba, F.lit(t).alias("threshold_used"), best.alias("pred_label"))
        top = F.array_position("_p", F.array_max("_p")).cast("int")  # of equal ones the first
        return out.select(*keep, *proba, F.element_at(F.array(*[F.lit(l) for l in labels]), top).alias("pred_label"))


def _encoder_tables(train: DataFrame, encodings: dict[str, str], target: str) -> tuple[DataFrame, float | None]:
    """(feature, value, code) of all lookup encoders, and the target's mean if one of them needs it."""
    tables, mean = [], None
    for kind, (col, _) in LOOKUPS.items():
        some = [c for c, e in encodings.items() if e == kind]
        if not some:
            continue
        if kind == "ordinal":
            t = P.fit_ordinal(train, some)
        elif kind == "frequency":
            t = P.fit_frequency(train, some)
        else:
            t, overall = P.fit_target_mean(train, some, target)
            mean = float(train.agg(F.avg(target)).first()[0])
        tables.append(t.select("feature", "value", F.col(col).cast("double").alias("code")))
    out = train.sparkSession.createDataFrame([], "feature string, value string, code double")
    for t in tables:
        out = out.unionByName(t)
    return out, mean


def fit_bundle(train: DataFrame, target: str, numeric: Sequence[str], categorical: Sequence[str] = (), task: str = "regression",
               model: str = "ols", encoding: str | dict[str, str] = "onehot", impute: str = "mean", scale: str = "standard",
               validation: DataFrame | None = None, conformal_alpha: float | None = None, threshold_metric: str | None = None,
               alpha: float = 1.0, n_features: int = 64, seed: int = 42, params: dict | None = None, weight_col: str | None = None) -> Bundle:
    """Fit the recipe and the model on ``train``; the conformal width and the threshold on ``validation``.

    ``encoding``: one of onehot, hashing, ordinal, frequency, target_mean (or one per column). ``model``: ols, ridge,
    lasso, elasticnet; random_forest, gradient_boosting, and for classification also logistic, mlp. Rows
    without a target take no part. Missing categories become the most frequent train value, or the missing token
    where a column has none."""
    if task not in ("regression", "classification"):
        raise ValueError(f"unknown task '{task}'")
    if task == "classification" and model in LINEAR or task == "regression" and model in ("logistic", "mlp"):
        raise ValueError(f"model '{model}' is not one for {task}")
    encodings = dict(encoding) if isinstance(encoding, dict) else {c: encoding for c in categorical}
    if unknown := {e for e in encodings.values()} - {"onehot", "hashing", *LOOKUPS}:
        raise ValueError(f"a bundle has no encoding {sorted(unknown)}")
    used = list(dict.fromkeys([target, *numeric, *encodings, *categorical]))
    known = lambda df, *more: stored(df.where(F.col(target).isNotNull()).select(*[P._q(c) for c in dict.fromkeys([*used, *more])]))
    spark, train = train.sparkSession, known(train, *([weight_col] if weight_col else []))  # each statistic is a pass
    labels = None
    if task == "classification":
        labels = [r[0] for r in train.select(F.col(target).cast("string")).distinct().orderBy(target).limit(1001).collect()]
        if not 2 <= len(labels) <= 1000:
            raise ValueError("a classification bundle needs 2 to 1000 classes")
        index = F.create_map(*[x for i, l in enumerate(labels) for x in (F.lit(l), F.lit(float(i)))])
        train = train.withColumn("_y", F.element_at(index, F.col(target).cast("string")))
    else:
        train = train.withColumn("_y", F.col(target).cast("double"))

    fills = P.fit_impute(train, list(numeric), impute) if numeric else {}
    sc = P.fit_scale(P.apply_impute(train, fills), list(numeric), scale) if numeric else {}
    modes = P.fit_impute(train, list(categorical), "most_frequent") if categorical else {}
    fields = [F.struct(F.lit(c).alias("feature"), fills[c].cast("double").alias("fill"), sc[c][0].cast("double").alias("center"),
                       sc[c][1].cast("double").alias("divisor"), F.lit(None).cast("string").alias("text")) for c in numeric]
    fields += [F.struct(F.lit(c).alias("feature"), *[F.lit(None).cast("double").alias(n) for n in ("fill", "center", "divisor")],
                        F.coalesce(modes[c].cast("string"), F.lit(MISSING_TOKEN)).alias("text")) for c in categorical]
    rows = spark.range(1).select(F.inline(F.array(*fields))).collect()  # one row per input column
    constants = spark.createDataFrame(rows, "feature string, fill double, center double, divisor double, text string")
    text = {r.feature: r.text for r in rows if r.text is not None}
    filled = train.withColumns({c: F.coalesce(P._q(c).cast("string"), F.lit(text[c])) for c in categorical}) if categorical else train
    onehot = [c for c, e in encodings.items() if e == "onehot"]
    lookups, mean = _encoder_tables(filled, encodings, "_y")
    spec = {"task": task, "target": target, "numeric": list(numeric), "encodings": encodings, "model": model, "labels": labels,
            "categories": P.fit_onehot(filled, onehot) if onehot else {}, "n_features": n_features, "target_mean": mean}
    recipe = Bundle(spec, constants, lookups, spark.createDataFrame([], "feature string, coefficient double"))

    ready = recipe.features(train)
    features = [f"num__{c}" for c in numeric]
    for c, e in encodings.items():
        features += ([f"cat__{c}_{v}" for v in spec["categories"][c]] if e == "onehot" else
                     [f"cat__{c}__hash_{i}" for i in range(n_features)] if e == "hashing" else [f"cat__{c}"])
    spec["features"] = features
    bundle = recipe
    if model in LINEAR:
        w, b = G.fit_linear_gram(ready, features, "_y", model, alpha)
        table = [(f, float(x)) for f, x in zip(features, w)] + [("__intercept__", float(b))]
        bundle = recipe._replace(coefficients=spark.createDataFrame(table, "feature string, coefficient double"))
    else:
        names = [f"_f{i}" for i in range(len(features))]
        plain = ready.select("_y", *([F.col(weight_col)] if weight_col else []), *[P._q(f).alias(n) for f, n in zip(features, names)])
        bundle = recipe._replace(fitted=G.fit_mllib(plain, names, "_y", model, task, len(labels or ()), seed, params, weight_col))
        spec["class"] = f"{type(bundle.fitted).__module__}.{type(bundle.fitted).__name__}"

    if validation is not None and not (conformal_alpha is None and threshold_metric is None):
        valid = known(validation)
        if conformal_alpha is not None and task == "regression":
            scored = bundle.score(valid, [target])
            spec["conformal_q"] = conformal_quantile(scored, target, "prediction", conformal_alpha).first()["q"]
        if threshold_metric is not None and labels is not None and len(labels) == 2:
            scored = bundle.score(valid, [target]).select((F.col(target).cast("string") == labels[1]).cast("int").alias("y_true"),
                                                          F.col(f"pred_proba_{sanitize_label(labels[1])}").alias("p"))
            spec["threshold"] = threshold_search(scored, metric=threshold_metric).where("is_best").first()["threshold"]
    return bundle


def save_bundle(bundle: Bundle, path: str) -> str:
    """Write a bundle's tables and model under ``path`` (replaced if there)."""
    spark = bundle.constants.sparkSession
    spark.createDataFrame([(json.dumps(bundle.spec),)], "spec string").write.mode("overwrite").parquet(f"{path}/spec")
    bundle.constants.write.mode("overwrite").parquet(f"{path}/constants")
    bundle.lookups.write.mode("overwrite").parquet(f"{path}/lookups")
    bundle.coefficients.write.mode("overwrite").parquet(f"{path}/coefficients")
    if bundle.fitted is not None:
        bundle.fitted.write().overwrite().save(f"{path}/model")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    import importlib
    spec = json.loads(spark.read.parquet(f"{path}/spec").first()["spec"])
    fitted = None
    if "class" in spec:
        module, name = spec["class"].rsplit(".", 1)
        if not module.startswith("pyspark.ml."):
            raise ValueError(f"not a model class of MLlib: {spec['class']}")
        fitted = getattr(importlib.import_module(module), name).load(f"{path}/model")
    return Bundle(spec, *[spark.read.parquet(f"{path}/{t}") for t in ("constants", "lookups", "coefficients")], fitted)
