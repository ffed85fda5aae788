"""Fit-on-train / transform-all preprocessing.

Fitting is an aggregate over the train rows; the fitted state is either a
scalar subquery (means, deviations, medians: evaluated once, shipped as a
value) or a lookup DataFrame keyed by (feature, value) that the transform
joins. Lookups are joined, not collected: a high-cardinality column makes a big
lookup, and Spark/AQE chooses broadcast or shuffle by its actual size. Only the
dense one-hot needs the category list on the driver (it defines output columns),
bounded by ``max_categories``; its sparse form has no bound."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_bucket
from quarry.functions.ranking import (BROADCAST_ROWS, bounded_broadcast, exact_quantiles, global_rank, join_null_safe, long_form,
                                      rank_within_groups, topk_per_group)
from quarry.functions.scalars import MISSING_TOKEN
from quarry.operators.splits import RandomSplit, apply_split, kfold_assign
from quarry.session import cut_lineage, stored

ENCODINGS = ("onehot", "onehot_sparse", "hashing", "auto", "frequency", "ordinal", "target_mean", "target_mean_oof")

# Smoothing strength of target encoding, auto one-hot limit.
TARGET_SMOOTHING = 10.0
AUTO_ONEHOT_MAX = 50

#: Categories of a column that may become columns of their own.
DENSE_ONEHOT_MAX = 1000


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# ------------------------------------------------------------------ F1 / F2 / F3
def fit_impute(train: DataFrame, columns: Sequence[str], strategy: str = "mean", fill_value=None) -> dict[str, Column]:
    """Fill value per column as a lazy scalar: mean, median (exact), most_frequent
    (ties -> smallest value) or constant."""
    if strategy == "mean":
        st = train.agg(F.struct(*[F.avg(_q(c)).alias(f"c{i}") for i, c in enumerate(columns)])).scalar()  # one subquery
        return {c: st[f"c{i}"] for i, c in enumerate(columns)}
    if strategy == "median":
        lf = long_form(train, [], columns, "double")
        q = exact_quantiles(lf, ["feature"], "value", [0.5])
        st = q.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"c{i}") for i, c in enumerate(columns)])).scalar()
        return {c: st[f"c{i}"] for i, c in enumerate(columns)}  # one subquery for all columns
    if strategy == "most_frequent":
        # One pass for all columns of a type: counts per (column, value), then the top one of each column.
        out = {}
        for kind in dict.fromkeys(train.schema[c].dataType.simpleString() for c in columns):
            some = [c for c in columns if train.schema[c].dataType.simpleString() == kind]
            counts = long_form(train, [], some, kind).where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            top = topk_per_group(counts, ["feature"], [F.col("n").desc(), F.col("value").asc()], 1)
            st = top.agg(F.struct(*[F.max(F.when(F.col("feature") == c, F.col("value"))).alias(f"c{i}") for i, c in enumerate(some)])).scalar()
            out |= {c: st[f"c{i}"] for i, c in enumerate(some)}
        return out
    if strategy == "constant":
        return {c: F.lit(fill_value) for c in columns}
    raise ValueError(f"unknown imputation strategy '{strategy}'")


def apply_impute(df: DataFrame, fills: dict[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(_q(c), v.cast(df.schema[c].dataType)) for c, v in fills.items()})


# ------------------------------------------------------------------ F4 / F5
def fit_scale(train: DataFrame, columns: Sequence[str], method: str = "standard") -> dict[str, tuple[Column, Column]]:
    """(center, divisor) per column: standard = (mean, population sd or 1);
    minmax = (min, range or 1); none = (0, 1)."""
    if method == "none":
        return {c: (F.lit(0.0), F.lit(1.0)) for c in columns}
    if method not in ("standard", "minmax"):
        raise ValueError(f"unknown scaler '{method}'")
    fields = []
    for i, c in enumerate(columns):
        if method == "standard":
            fields += [F.avg(_q(c)).alias(f"a{i}"), F.coalesce(F.nullif(F.stddev_pop(_q(c)), F.lit(0.0)), F.lit(1.0)).alias(f"b{i}")]
        else:
            fields += [F.min(_q(c)).alias(f"a{i}"),
                       F.coalesce(F.nullif(F.max(_q(c)) - F.min(_q(c)), F.lit(0.0)), F.lit(1.0)).alias(f"b{i}")]
    st = train.agg(F.struct(*fields)).scalar()  # all fitted constants in one subquery
    return {c: (st[f"a{i}"], st[f"b{i}"]) for i, c in enumerate(columns)}


def apply_scale(df: DataFrame, params: dict[str, tuple[Column, Column]], prefix: str = "") -> DataFrame:
    return df.withColumns({f"{prefix}{c}": (_q(c) - m) / s for c, (m, s) in params.items()})


# ------------------------------------------------------------------ F7
def fit_onehot(train: DataFrame, columns: Sequence[str], max_categories: int = DENSE_ONEHOT_MAX) -> dict[str, list]:
    """Sorted train categories per column. They become output columns, so they come to the driver, at most
    ``max_categories`` of a column: above that the call raises (see :func:`onehot_dictionary`)."""
    lf = long_form(train, [], columns, "string").where(F.col("value").isNotNull()).distinct()
    sizes = {r.feature: r.n for r in lf.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    too_big = [c for c, n in sizes.items() if n > max_categories]
    if too_big:
        raise ValueError(f"one column per category refused for {too_big}; use onehot_sparse or hashing")
    got: dict[str, list] = {c: [] for c in columns}
    for r in lf.orderBy("feature", "value").collect():  # at most max_categories a column
        got[r.feature].append(r.value)
    return got


def onehot_dictionary(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, index): the train categories of all columns numbered 0..n-1 in the order of the dense
    one-hot's columns (by column, then by value). Numbered by the distributed rank: no category reaches the driver."""
    place = F.element_at(F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)]), F.col("feature"))
    lf = long_form(train, [], columns, "string").where(F.col("value").isNotNull()).distinct()
    return global_rank(lf.withColumn("_place", place), ["_place", "value"], "index").select("feature", "value", "index")


def apply_onehot_sparse(df: DataFrame, dictionary: DataFrame, columns: Sequence[str], prefix: str = "cat__") -> DataFrame:
    """Adds ``{prefix}size`` (the dictionary's), ``{prefix}indices`` (ascending) and ``{prefix}values`` (all 1.0): the
    non-zero places of the dense one-hot row. Missing and unseen values have none. One join per column,
    broadcast while the column's categories are few, else shuffled."""
    out = apply_lookup(df, dictionary, columns, "index", None, prefix="_oh_", null_safe=False)
    size = dictionary.agg(F.count(F.lit(1))).scalar()
    found = F.array_compact(F.array(*[F.col(f"`_oh_{c}`").cast("bigint") for c in columns]))
    out = out.withColumn(f"{prefix}size", size).withColumn(f"{prefix}indices", found)
    out = out.withColumn(f"{prefix}values", F.array_repeat(F.lit(1.0), F.size(f"{prefix}indices")))
    return out.drop(*[f"_oh_{c}" for c in columns])


def apply_onehot(df: DataFrame, cats: dict[str, list], prefix: str = "cat__") -> DataFrame:
    """One 0/1 double column per train category; unseen values are all zeros."""
    cols = []
    for c, values in cats.items():
        s = _q(c).cast("string")
        cols += [F.when(s == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{prefix}{c}_{v}") for v in values]
    return df.select("*", *cols)


# ------------------------------------------------------------------ F8 / F9 / F11
def fit_ordinal(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, code): 0-based position of each train value in sorted order."""
    lf = long_form(train, [], columns, "string").where(F.col("value").isNotNull()).distinct()
    return rank_within_groups(lf, ["feature"], ["value"], "code")


def fit_frequency(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, freq) with NULL as its own value."""
    lf = long_form(train, [], columns, "string")
    n = train.count()
    return lf.groupBy("feature", "value").agg((F.count(F.lit(1)) / F.lit(float(n))).alias("freq"))


def fit_target_mean(train: DataFrame, columns: Sequence[str], target: str, smoothing: float = TARGET_SMOOTHING) -> tuple[DataFrame, Column]:
    """(feature, value, enc) with enc = (n_v*mean_v + s*global) / (n_v + s); global as a scalar."""
    g = train.agg(F.avg(_q(target))).scalar()
    lf = long_form(train.select(*columns, _q(target).alias("_y")), ["_y"], columns, "string")
    st = lf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"), F.avg("_y").alias("_m"))
    enc = (F.col("_n") * F.col("_m") + F.lit(smoothing) * g) / (F.col("_n") + F.lit(smoothing))
    return st.select("feature", "value", enc.alias("enc")), g


def apply_lookup(df: DataFrame, lookup: DataFrame, columns: Sequence[str], value_col: str, default,
                 prefix: str = "cat__", null_safe: bool = True) -> DataFrame:
    """Replace each column by its looked-up code (left join per column; NULL-safe match)."""
    out = df
    for c in columns:
        lk = bounded_broadcast(lookup.where(F.col("feature") == c).select(F.col("value").alias("_lv"), F.col(value_col).alias("_code")))
        cond = out[c].cast("string").eqNullSafe(lk["_lv"]) if null_safe else out[c].cast("string") == lk["_lv"]
        out = out.join(lk, cond, "left").withColumn(f"{prefix}{c}", F.coalesce(F.col("_code").cast("double"), (default if isinstance(default, Column) else F.lit(default)).cast("double"))).drop("_lv", "_code")
    return out


# ------------------------------------------------------------------ F10
def apply_hashing(df: DataFrame, columns: Sequence[str], n_features: int = 64, prefix: str = "cat__", seed: int = 0) -> DataFrame:
    """Bucket of "col=value" (NULL -> __MISSING__) into n_features 0/1 columns per source column."""
    cols = []
    for c in columns:
        token = F.concat(F.lit(f"{c}="), F.coalesce(_q(c).cast("string"), F.lit(MISSING_TOKEN)))
        b = hash_bucket(seed, token, n_features)
        cols += [F.when(b == i, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{prefix}{c}__hash_{i}") for i in range(n_features)]
    return df.select("*", *cols)


# ------------------------------------------------------------------ F12
def target_mean_oof(df: DataFrame, split: DataFrame, row_id: str, columns: Sequence[str], target: str,
                    fold_col: str = "fold", smoothing: float = TARGET_SMOOTHING) -> DataFrame:
    """Out-of-fold target encoding; ``df`` carries a fold column. Train rows use the
    statistics of the other folds (total minus own fold: one aggregate per
    (value) and per (value, fold), no k refits); other rows use all train rows.
    Both cases live in one lookup keyed by (value, fold), the non-train case under
    fold -1, so each column costs one join. Adds ``cat__{c}``."""
    flagged = df.join(split.select(row_id, "split"), row_id)
    tr = flagged.where(F.col("split") == "train")
    lf = long_form(tr.select(fold_col, _q(target).alias("_y"), *columns), [fold_col, "_y"], columns, "string")
    # The only pass over the train rows: sums per (column, value, fold). A row counts once for each column, so the
    # totals per fold and over all come from those of the first column.
    byf = cut_lineage(lf.groupBy("feature", "value", fold_col).agg(F.count(F.lit(1)).alias("_nf"), F.count("_y").alias("_kf"), F.sum("_y").alias("_sf")))
    tot = byf.groupBy("feature", "value").agg(F.sum("_nf").alias("_n"), F.sum("_sf").alias("_s"))
    one = byf.where(F.col("feature") == columns[0])
    g = one.agg(F.struct((F.sum("_sf") / F.sum("_kf")).alias("a"), F.sum("_nf").alias("n"), F.sum("_sf").alias("s"))).scalar()
    g_all, g_n, g_s = g["a"], g["n"], g["s"]
    gf = one.groupBy(fold_col).agg(((g_s - F.sum("_sf")) / (g_n - F.sum("_nf"))).alias("_gm"))  # k rows
    oof = (join_null_safe(byf, tot, ["feature", "value"]).join(F.broadcast(gf), fold_col)
           .select("feature", "value", F.col(fold_col).alias("_k"),
                   (((F.col("_s") - F.col("_sf")) + F.lit(smoothing) * F.col("_gm"))
                    / ((F.col("_n") - F.col("_nf")) + F.lit(smoothing))).alias("enc")))
    full = tot.select("feature", "value", F.lit(-1).cast(byf.schema[fold_col].dataType).alias("_k"),
                      ((F.col("_s") + F.lit(smoothing) * g_all) / (F.col("_n") + F.lit(smoothing))).alias("enc"))
    lookup = cut_lineage(oof.unionByName(full))  # every column's join reads it
    few = lookup.count() <= BROADCAST_ROWS
    key = F.when(F.col("split") == "train", F.col(fold_col)).otherwise(F.lit(-1))
    out = flagged.withColumn("_key", key.cast(byf.schema[fold_col].dataType))
    for c in columns:
        lk = lookup.where(F.col("feature") == c).select(F.col("value").alias("_v"), F.col("_k"), F.col("enc").alias("_e"))
        lk = F.broadcast(lk) if few else lk
        cond = out[c].cast("string").eqNullSafe(lk["_v"]) & (out["_key"] == lk["_k"])
        # train rows always find their own (value, fold); unseen values elsewhere get the global mean
        out = out.join(lk, cond, "left").withColumn(f"cat__{c}", F.coalesce(F.col("_e"), g_all)).drop("_v", "_k", "_e")
    return out.drop("_key")


# ------------------------------------------------------------------ F13 / F19
def label_encode(df: DataFrame, label: str, mode: str = "auto") -> tuple[DataFrame, DataFrame]:
    """Classes sorted -> 0..k-1. Returns (df with ``label_index``, class table). Needs >= 2 classes;
    ``binary`` requires exactly 2, ``multiclass`` more than 2."""
    classes = df.select(_q(label).alias("cls")).where(F.col("cls").isNotNull()).distinct()
    ranked = rank_within_groups(classes.withColumn("_g", F.lit(0)), ["_g"], ["cls"], "index").drop("_g")
    k = classes.count()
    if k < 2 or (mode == "binary" and k != 2) or (mode == "multiclass" and k <= 2):
        raise ValueError(f"label has {k} classes, not valid for mode '{mode}'")
    out = df.join(bounded_broadcast(ranked), df[label] == ranked["cls"], "left").drop("cls").withColumnRenamed("index", "label_index")
    return out, ranked


# ------------------------------------------------------------------ F14 / F17
def auto_encodings(train: DataFrame, columns: Sequence[str], max_onehot: int = AUTO_ONEHOT_MAX) -> dict[str, str]:
    """one-hot when the train column has at most max_onehot distinct non-null values, else hashing."""
    lf = long_form(train, [], columns, "string").where(F.col("value").isNotNull()).distinct()
    n = {r.feature: r.n for r in lf.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per column
    return {c: ("onehot" if n.get(c, 0) <= max_onehot else "hashing") for c in columns}


def encoding_report(train: DataFrame, encodings: dict[str, str], n_features: int = 64) -> DataFrame:
    """(column, encoding, train_uniques, encoded_dim) and the total as a column."""
    cols = list(encodings)
    lf = long_form(train, [], cols, "string").where(F.col("value").isNotNull()).distinct()
    u = lf.groupBy("feature").agg(F.count(F.lit(1)).alias("train_uniques"))
    enc = train.sparkSession.createDataFrame(list(encodings.items()), "feature string, encoding string")
    rep = enc.join(u, "feature", "left").fillna(0, ["train_uniques"])
    dim = (F.when(F.col("encoding") == "hashing", F.lit(n_features))
           .when(F.col("encoding").isin("frequency", "ordinal", "target", "target_mean", "target_mean_oof"), F.lit(1)).otherwise(F.col("train_uniques")))
    rep = rep.select(F.col("feature").alias("column"), "encoding", "train_uniques", dim.cast("bigint").alias("encoded_dim"))
    return rep.withColumn("total_dim", F.sum("encoded_dim").over(Window.partitionBy(F.lit(1))))  # one row per column


# ------------------------------------------------------------------ F16
def preprocess_fit_transform(df: DataFrame, split: DataFrame | RandomSplit, row_id: str, numeric: Sequence[str],
                             categorical: Sequence[str], target: str, impute: str = "mean", scale: str = "standard",
                             encoding: str = "onehot", n_features: int = 64, categorical_impute: str = "most_frequent",
                             folds: int = 5, seed: int = 42) -> DataFrame:
    """Numeric block (impute then scale, ``num__{c}``) then categorical block
    (``cat__{c}_{v}``, ``cat__{c}__hash_{i}`` or ``cat__{c}``), fitted on train rows.

    ``encoding``: onehot, onehot_sparse (``cat__size``, ``cat__indices``, ``cat__values``), hashing, auto (one of the two per column), frequency, ordinal
    (unseen values -1), target_mean, or target_mean_oof (train rows out of fold over
    ``folds`` md5 folds). ``categorical_impute``: most_frequent, constant (the missing
    token) or none. Other names raise."""
    if encoding not in ENCODINGS:
        raise ValueError(f"unknown encoding '{encoding}', known: {', '.join(ENCODINGS)}")
    if categorical_impute not in ("most_frequent", "constant", "none"):
        raise ValueError(f"unknown categorical imputation '{categorical_impute}'")
    # Every statistic is a pass over the train rows, and a lazy one is taken again by each job that uses it.
    train = stored(apply_split(df, split, row_id, "train").select(*[_q(c) for c in dict.fromkeys([row_id, *numeric, *categorical, target])]))
    fills = fit_impute(train, numeric, impute)
    imputed_train = apply_impute(train, fills)
    sc = fit_scale(imputed_train, numeric, scale)
    out = apply_scale(apply_impute(df, fills), sc, prefix="num__")
    known = fit_impute(train, categorical, "most_frequent") if categorical_impute == "most_frequent" else {}
    # A column without any train value has no most frequent one: the missing token is its category.
    cat_fill = {} if categorical_impute == "none" else {
        c: F.coalesce(known[c].cast("string"), F.lit(MISSING_TOKEN)) if c in known else F.lit(MISSING_TOKEN) for c in categorical}
    as_text = {c: F.coalesce(_q(c).cast("string"), cat_fill[c]) if c in cat_fill else _q(c).cast("string") for c in categorical}
    out = out.withColumns(as_text)
    train_c = train.withColumns(as_text)
    encs = auto_encodings(train_c, categorical) if encoding == "auto" else {c: encoding for c in categorical}
    oh = [c for c, e in encs.items() if e == "onehot"]
    hs = [c for c, e in encs.items() if e == "hashing"]
    if oh:
        out = apply_onehot(out, fit_onehot(train_c, oh))
    sp = [c for c, e in encs.items() if e == "onehot_sparse"]
    if sp:
        out = apply_onehot_sparse(out, onehot_dictionary(train_c, sp), sp)
    if hs:
        out = apply_hashing(out, hs, n_features)
    fq = [c for c, e in encs.items() if e == "frequency"]
    if fq:
        out = apply_lookup(out, fit_frequency(train_c, fq), fq, "freq", 0.0)
    od = [c for c, e in encs.items() if e == "ordinal"]
    if od:
        out = apply_lookup(out, fit_ordinal(train_c, od), od, "code", -1.0)
    tm = [c for c, e in encs.items() if e == "target_mean"]
    if tm:
        lookup, overall = fit_target_mean(train_c, tm, target)
        out = apply_lookup(out, lookup, tm, "enc", overall)
    oof = [c for c, e in encs.items() if e == "target_mean_oof"]
    if oof:
        fold = kfold_assign(df, row_id, folds, seed).withColumnRenamed("fold", "_fold")
        out = target_mean_oof(out.join(fold, row_id), split.table(df) if isinstance(split, RandomSplit) else split, row_id, oof, target, "_fold")
    keep = [row_id, target] + [c for c in out.columns if c.startswith("num__") or c.startswith("cat__")]
    return out.select(*[_q(c) for c in keep])
