"""Profiling (C1-C9). All statistics are single aggregates or
``groupBy(feature[, value])`` on the long form; top-k uses the salted two-stage
helper; sampling is a seeded bottom-n by hash (distributed top-n, no shuffle of
the whole table)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit
from quarry.functions.ranking import long_form, topk_per_group
from quarry.operators.evaluate import equal_width_hist
from quarry.operators.schema import feature_types, null_counts


# ------------------------------------------------------------------ C1
def table_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """rows, columns, missing_total, missing_rate = missing / (rows*cols), missing_columns."""
    cols = list(columns) if columns is not None else df.columns
    nc = null_counts(df, cols)
    ncols = len(cols)
    return nc.agg(
        F.max("rows").alias("rows"),
        F.lit(ncols).cast("bigint").alias("columns"),
        F.coalesce(F.sum("null_count"), F.lit(0)).cast("bigint").alias("missing_total"),
        F.coalesce(F.count_if(F.col("null_count") > 0), F.lit(0)).cast("bigint").alias("missing_columns"),
    ).select("rows", "columns", "missing_total",
             F.when((F.col("rows") * F.col("columns")) > 0,
                    F.col("missing_total") / (F.col("rows") * F.col("columns"))).otherwise(F.lit(0.0)).alias("missing_rate"),
             "missing_columns")


# ------------------------------------------------------------------ C2
def profile_summary(df: DataFrame, target: str | None = None, ids: Sequence[str] = (), drops: Sequence[str] = ()) -> DataFrame:
    """C1 plus the number of numeric and categorical features (schema-derived)."""
    num, cat = feature_types(df.schema, [c for c in df.columns if c not in {target, *ids, *drops}])
    return table_summary(df).select("*", F.lit(len(num)).cast("bigint").alias("numeric_features"),
                                    F.lit(len(cat)).cast("bigint").alias("categorical_features"))


# ------------------------------------------------------------------ C3
def missingness_by_column(df: DataFrame, top: int = 30) -> DataFrame:
    """Missing rate per column, descending (ties: column name), top n."""
    nc = null_counts(df, df.columns)
    return (nc.select("column", F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).otherwise(0.0).alias("missing_rate"))
            .orderBy(F.col("missing_rate").desc(), F.col("column").asc()).limit(top))


# ------------------------------------------------------------------ C4
def numeric_histogram(df: DataFrame, columns: Sequence[str], bins: int = 30) -> DataFrame:
    """Equal-width histogram per numeric column -> (feature, bin, lo, hi, count)."""
    lf = long_form(df, [], columns, "double")
    return equal_width_hist(lf, "value", bins, ["feature"])


# ------------------------------------------------------------------ C5
def categorical_topk(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """Top-k values per categorical column, nulls dropped -> (feature, rank, value, count)."""
    lf = long_form(df, [], columns, "string").where(F.col("value").isNotNull())
    counts = lf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    return topk_per_group(counts, ["feature"], [F.col("count").desc(), F.col("value").asc()], k, "rank")


# ------------------------------------------------------------------ C6
def target_distribution(df: DataFrame, target: str, bins: int = 30, k: int = 10) -> DataFrame:
    """Histogram when the target is numeric (not boolean), else top-k counts."""
    num, _ = feature_types(df.schema, [target])
    if num:
        return numeric_histogram(df, [target], bins).select(
            "feature", "bin", F.lit(None).cast("string").alias("value"), "lo", "hi", "count")
    return categorical_topk(df, [target], k).select(
        "feature", F.col("rank").alias("bin"), "value", F.lit(None).cast("double").alias("lo"),
        F.lit(None).cast("double").alias("hi"), "count")


# ------------------------------------------------------------------ C7
def profile_compare(raw: DataFrame, processed: DataFrame, target: str | None = None) -> DataFrame:
    """Raw vs processed: rows, features, numeric, categorical, missing_rate, missing_columns
    as (metric, raw, processed)."""
    def summ(d):
        feats = [c for c in d.columns if c != target]
        num, cat = feature_types(d.schema, feats)
        s = table_summary(d, feats)
        return s.select(F.col("rows").cast("double").alias("rows"), F.lit(float(len(feats))).alias("features"),
                        F.lit(float(len(num))).alias("numeric"), F.lit(float(len(cat))).alias("categorical"),
                        F.col("missing_rate").cast("double").alias("missing_rate"),
                        F.col("missing_columns").cast("double").alias("missing_columns"))
    metrics = ["rows", "features", "numeric", "categorical", "missing_rate", "missing_columns"]
    a = summ(raw).unpivot([], metrics, "metric", "raw")
    b = summ(processed).unpivot([], metrics, "metric", "processed")
    return a.join(b, "metric")


# ------------------------------------------------------------------ C8
def sample_rows(df: DataFrame, row_id: str, n: int, seed: int = 0) -> DataFrame:
    """Seeded uniform sample of n rows (all rows when there are at most n): bottom-n
    by md5(seed:row_id). Deterministic and independent of partitioning; runs as a
    distributed top-n (each task keeps n rows)."""
    return (df.withColumn("_h", hash_unit(seed, row_id)).orderBy("_h", row_id).limit(n).drop("_h"))


# ------------------------------------------------------------------ C9
def quality_after_preprocess(raw: DataFrame, processed: DataFrame, target: str | None = None) -> DataFrame:
    """Missing before/after and reduction; column counts before/after; dropped columns."""
    rc = [c for c in raw.columns if c != target]
    pc = [c for c in processed.columns if c != target]
    a = table_summary(raw, rc).select(F.col("missing_total").alias("missing_before"))
    b = table_summary(processed, pc).select(F.col("missing_total").alias("missing_after"))
    mb, ma = a.select("missing_before").scalar(), b.select("missing_after").scalar()
    dropped = [c for c in rc if c not in pc]
    return raw.sparkSession.range(1).select(
        mb.alias("missing_before"), ma.alias("missing_after"), (mb - ma).alias("missing_reduction"),
        F.lit(len(rc)).cast("bigint").alias("columns_before"), F.lit(len(pc)).cast("bigint").alias("columns_after"),
        F.lit(len(dropped)).cast("bigint").alias("dropped_columns"))
