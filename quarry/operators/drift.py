"""Drift profiles and reports.

A train table is profiled once (moments, exact quantiles, quantile histogram
edges, categorical top-k); a new table is binned against the train edges and
compared with PSI and a binned KS statistic.

Plan shape: both tables are unpivoted once to ``(feature, value)``; every
statistic is a ``groupBy(feature[, bin])`` with map-side partial aggregation.
Quantiles use the distributed exact-quantile helper (a range-partitioned sort),
never a per-feature value buffer. The only broadcast is the edge table: one row
per feature with at most ``bins + 1`` edges, a bound fixed by the schema and the
parameters, not by the data."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.ranking import approx_quantiles, exact_quantiles, first_index_above_array, long_form, topk_per_group

# Fixed values (reference defaults): bins, profile quantiles, top categories,
# PSI share floor, warn / fail thresholds.
DEFAULT_BINS = 10
DEFAULT_QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
DEFAULT_MAX_CATEGORIES = 10
PSI_EPSILON = 1e-06
PSI_WARN = 0.2
PSI_FAIL = 0.4


def quantile_name(q: float) -> str:
    return f"p{int(round(q * 100)):02d}"


def _features_df(spark, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature string, feature_pos int")


def _numeric_long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """NaN is a missing value; infinities stay and are left out where edges and counts are made."""
    return long_form(df, [], features, "double").withColumn("value", F.when(~F.isnan("value"), F.col("value")))


def _finite(c) -> F.Column:
    """The number, or null if it is infinite or NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def _categorical_long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return long_form(df, [], features, "string")


# ------------------------------------------------------------------ K1
def profile_numeric(df: DataFrame, features: Sequence[str], quantiles: Sequence[float] = DEFAULT_QUANTILES) -> DataFrame:
    """Per feature: count, missing_count, mean, population std, min, max, p05..p95."""
    lf = _numeric_long(df, features)
    moments = lf.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.count_if(F.col("value").isNull()).alias("missing_count"),
        _finite(F.avg("value")).alias("mean"),
        _finite(F.stddev_pop("value")).alias("std"),
        _finite(F.min("value")).alias("min"),
        _finite(F.max("value")).alias("max"),
    )
    q = exact_quantiles(lf, ["feature"], "value", quantiles)
    wide = q.groupBy("feature").agg(*[_finite(F.max(F.when(F.col("qi") == i, F.col("value")))).alias(quantile_name(v))
                                      for i, v in enumerate(quantiles)])
    return moments.join(wide, "feature", "left")


# ------------------------------------------------------------------ K2
def hist_edges(df: DataFrame, features: Sequence[str], bins: int = DEFAULT_BINS) -> DataFrame:
    """Quantile edges at i/bins, de-duplicated and sorted -> (feature, edges array<double>).
    A single edge c becomes [c - eps, c + eps] with eps = |c|*1e-6 (1e-6 if c = 0);
    a feature without values gets [0, 1]."""
    return _edges(df, features, bins, exact_quantiles)


def hist_edges_approx(df: DataFrame, features: Sequence[str], bins: int = DEFAULT_BINS, accuracy: int = 10000) -> DataFrame:
    """Opt-in sketch-based edges (no sort of the values); see :func:`approx_quantiles`."""
    return _edges(df, features, bins, lambda d, g, v, qs: approx_quantiles(d, g, v, qs, accuracy))


def _edges(df: DataFrame, features: Sequence[str], bins: int, quantiles_fn) -> DataFrame:
    qs = [i / bins for i in range(bins + 1)]
    q = quantiles_fn(_numeric_long(df, features).withColumn("value", _finite("value")), ["feature"], "value", qs)
    raw = q.groupBy("feature").agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_e"))
    c = F.col("_e")[0]
    eps = F.when(F.abs(c) * F.lit(1e-6) == 0, F.lit(1e-6)).otherwise(F.abs(c) * F.lit(1e-6))
    edges = F.when(F.size("_e") == 1, F.array(c - eps, c + eps)).otherwise(F.col("_e"))
    feats = _features_df(df.sparkSession, features)
    fitted = (feats.join(raw, "feature", "left")
              .select("feature", F.coalesce(edges, F.array(F.lit(0.0), F.lit(1.0))).alias("edges")))
    # The edge table is the fitted train profile: one row per feature with at most
    # bins + 1 doubles, so it is materialised once and reused by every consumer.
    rows = [(r.feature, [float(x) for x in r.edges]) for r in fitted.collect()]
    return df.sparkSession.createDataFrame(rows, "feature string, edges array<double>")


def bin_index(value, edges, max_edges: int = DEFAULT_BINS + 1) -> F.Column:
    """numpy.histogram rule: bins left-closed, last bin closed; outside -> NULL.
    Evaluated as a CASE chain over at most ``max_edges`` sorted edges."""
    v = F.col(value) if isinstance(value, str) else value
    e = F.col(edges) if isinstance(edges, str) else edges
    n = F.size(e)
    last = F.element_at(e, -1)
    return (F.when(v.isNull() | (v < e[0]) | (v > last), F.lit(None).cast("int"))
            .when(v == last, n - 2)
            .otherwise(first_index_above_array(v, e, max_edges) - 1))


# ------------------------------------------------------------------ K3
def hist_counts(df: DataFrame, features: Sequence[str], edges: DataFrame) -> DataFrame:
    """Counts per (feature, bin) against given edges, zero-filled; values outside the
    edges are dropped (reference behaviour)."""
    lf = _numeric_long(df, features).where(_finite("value").isNotNull())
    # Edge table: one row per feature, <= bins+1 doubles each -> bounded broadcast.
    max_edges = max([len(r.edges) for r in edges.select("edges").collect()] or [2])  # one row per feature
    binned = lf.join(F.broadcast(edges), "feature").select("feature", bin_index("value", "edges", max_edges).alias("bin"))
    counts = binned.where(F.col("bin").isNotNull()).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = edges.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
    return grid.join(counts, ["feature", "bin"], "left").select(
        "feature", F.col("bin").cast("bigint").alias("bin"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


# ------------------------------------------------------------------ K4
def profile_categorical(df: DataFrame, features: Sequence[str], k: int = DEFAULT_MAX_CATEGORIES) -> DataFrame:
    """Top-k values per feature by count (ties: value ascending) with rate, plus the
    feature's non-null total, missing count and the 'other' remainder."""
    lf = _categorical_long(df, features)
    # one aggregate per (feature, value) incl. NULL; totals and missing counts derive from it
    all_counts = lf.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = all_counts.groupBy("feature").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("count")).otherwise(0)).alias("total"),
        F.sum(F.when(F.col("value").isNull(), F.col("count")).otherwise(0)).alias("missing_count"))
    counts = all_counts.where(F.col("value").isNotNull())
    top = topk_per_group(counts, ["feature"], [F.col("count").desc(), F.col("value").asc()], k, "rank")
    top_sum = top.groupBy("feature").agg(F.sum("count").alias("_top"))
    return (top.join(totals, "feature").join(top_sum, "feature")
            .select("feature", "rank", "value", "count",
                    (F.col("count") / F.col("total")).alias("rate"),
                    "total", "missing_count",
                    F.greatest(F.col("total") - F.col("_top"), F.lit(0)).alias("other_count")))


def _missing_stats(df: DataFrame, features: Sequence[str], value_type: str, prefix: str) -> DataFrame:
    lf = _numeric_long(df, features) if value_type == "double" else long_form(df, [], features, value_type)
    return lf.groupBy("feature").agg(
        F.count("value").alias(f"{prefix}_count"), F.count_if(F.col("value").isNull()).alias(f"{prefix}_missing"))


def _missing_rate(count_col: str, missing_col: str) -> F.Column:
    denom = F.col(count_col) + F.col(missing_col)
    return F.when(denom <= 0, F.lit(0.0)).otherwise(F.col(missing_col) / denom)


def _psi_ks(buckets: DataFrame, with_ks: bool) -> DataFrame:
    """buckets: (feature, bin, e, a) -> (feature, psi, ks). NULL when a total is 0."""
    w = Window.partitionBy("feature")
    wcum = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = (buckets.withColumn("_E", F.sum("e").over(w)).withColumn("_A", F.sum("a").over(w))
         .withColumn("_es", F.greatest(F.try_divide(F.col("e"), F.col("_E")), F.lit(PSI_EPSILON)))
         .withColumn("_as", F.greatest(F.try_divide(F.col("a"), F.col("_A")), F.lit(PSI_EPSILON)))
         .withColumn("_term", (F.col("_as") - F.col("_es")) * F.ln(F.col("_as") / F.col("_es"))))
    aggs = [F.when((F.first("_E") > 0) & (F.first("_A") > 0), F.sum("_term")).alias("psi")]
    if with_ks:
        b = (b.withColumn("_ce", F.sum(F.try_divide(F.col("e"), F.col("_E"))).over(wcum))
             .withColumn("_ca", F.sum(F.try_divide(F.col("a"), F.col("_A"))).over(wcum)))
        aggs.append(F.when((F.first("_E") > 0) & (F.first("_A") > 0), F.max(F.abs(F.col("_ca") - F.col("_ce")))).alias("ks"))
    return b.groupBy("feature").agg(*aggs)


def _status(psi: F.Column, warn: float, fail: float | None, strict: bool) -> F.Column:
    s = F.when(psi.isNull(), F.lit("n/a"))
    if strict and fail is not None:
        s = s.when(psi >= F.lit(fail), F.lit("fail"))
    return s.when(psi >= F.lit(warn), F.lit("warn")).otherwise(F.lit("ok"))


# ------------------------------------------------------------------ K5 / K7
def _binned_counts(df: DataFrame, features: Sequence[str], edges: DataFrame, max_edges: int) -> DataFrame:
    """One pass: counts per (feature, bin) with bin -1 for NULL and -2 for values
    outside the edges, so histogram and missing statistics share one aggregate."""
    lf = _numeric_long(df, features)
    b = bin_index("value", "edges", max_edges)
    code = F.when(F.col("value").isNull(), F.lit(-1)).otherwise(F.coalesce(b, F.lit(-2)))
    return lf.join(F.broadcast(edges), "feature").groupBy("feature", code.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def drift_numeric(train: DataFrame, new: DataFrame, features: Sequence[str], bins: int = DEFAULT_BINS,
                  warn: float = PSI_WARN, fail: float | None = PSI_FAIL, strict: bool = False) -> DataFrame:
    """Per numeric feature: psi, ks, status, missing rates (train vs new). Each side is
    read once after the edges are fitted."""
    present = [f for f in features if f in new.columns]
    edges = hist_edges(train, features, bins)
    max_edges = max([len(r.edges) for r in edges.select("edges").collect()] or [2])  # one row per feature
    parts = []
    if present:
        e_p = edges.where(F.col("feature").isin(present))
        tc = _binned_counts(train, present, e_p, max_edges)
        nc = _binned_counts(new, present, e_p, max_edges)
        grid = e_p.select("feature", F.explode(F.sequence(F.lit(0), F.size("edges") - 2)).alias("bin"))
        buckets = (grid.join(tc.withColumnRenamed("n", "e"), ["feature", "bin"], "left")
                   .join(nc.withColumnRenamed("n", "a"), ["feature", "bin"], "left")
                   .select("feature", "bin", F.coalesce("e", F.lit(0)).cast("double").alias("e"),
                           F.coalesce("a", F.lit(0)).cast("double").alias("a")))
        stats = _psi_ks(buckets, True)

        def miss(counts, prefix):
            return counts.groupBy("feature").agg(F.sum(F.when(F.col("bin") != -1, F.col("n")).otherwise(0)).alias(f"{prefix}_count"),
                                                 F.sum(F.when(F.col("bin") == -1, F.col("n")).otherwise(0)).alias(f"{prefix}_missing"))
        m = miss(tc, "tr").join(miss(nc, "nw"), "feature")
        parts.append(stats.join(m, "feature").select(
            "feature", F.lit("numeric").alias("kind"), "psi", "ks",
            _status(F.col("psi"), warn, fail, strict).alias("status"),
            _missing_rate("tr_count", "tr_missing").alias("missing_rate_train"),
            _missing_rate("nw_count", "nw_missing").alias("missing_rate_infer")))
    absent = [f for f in features if f not in new.columns]
    if absent:
        parts.append(_absent_rows(train, absent, "numeric"))
    return _union(parts)


def _absent_rows(train: DataFrame, absent: Sequence[str], kind: str) -> DataFrame:
    return _features_df(train.sparkSession, absent).select(
        "feature", F.lit(kind).alias("kind"), F.lit(None).cast("double").alias("psi"),
        F.lit(None).cast("double").alias("ks"), F.lit("missing").alias("status"),
        F.lit(None).cast("double").alias("missing_rate_train"), F.lit(None).cast("double").alias("missing_rate_infer"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ K6
def drift_categorical(train: DataFrame, new: DataFrame, features: Sequence[str], k: int = DEFAULT_MAX_CATEGORIES,
                      warn: float = PSI_WARN, fail: float | None = PSI_FAIL, strict: bool = False) -> DataFrame:
    """PSI over the train top-k values plus one 'other' bucket per categorical feature."""
    present = [f for f in features if f in new.columns]
    parts = []
    if present:
        prof = profile_categorical(train, present, k)
        # Top table: <= k rows per feature -> bounded.
        top = prof.select("feature", "value", F.col("count").alias("e"))
        nl = _categorical_long(new, present)
        nall = nl.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("a"))  # one pass over the new side
        ntot = nall.groupBy("feature").agg(F.sum(F.when(F.col("value").isNotNull(), F.col("a")).otherwise(0)).alias("nw_count"),
                                           F.sum(F.when(F.col("value").isNull(), F.col("a")).otherwise(0)).alias("nw_missing"))
        # top values: <= k per feature, so the join side is bounded
        ncounts = nall.join(F.broadcast(top.select("feature", "value")), ["feature", "value"])
        top_rows = top.join(ncounts, ["feature", "value"], "left").select(
            "feature", "value", F.col("e").cast("double").alias("e"), F.coalesce("a", F.lit(0)).cast("double").alias("a"))
        sums = top_rows.groupBy("feature").agg(F.sum("e").alias("_se"), F.sum("a").alias("_sa"))
        tr = prof.select("feature", "total", "missing_count", "other_count").distinct()
        other = (tr.join(sums, "feature").join(ntot, "feature").select(
            "feature", F.lit(None).cast("string").alias("value"),
            F.col("other_count").cast("double").alias("e"),
            F.greatest(F.col("nw_count") - F.col("_sa"), F.lit(0)).cast("double").alias("a")))
        buckets = top_rows.unionByName(other).withColumn("bin", F.coalesce("value", F.lit("￿")))
        stats = _psi_ks(buckets, False)
        miss = tr.join(ntot, "feature")
        parts.append(stats.join(miss, "feature").select(
            "feature", F.lit("categorical").alias("kind"), "psi", F.lit(None).cast("double").alias("ks"),
            _status(F.col("psi"), warn, fail, strict).alias("status"),
            _missing_rate("total", "missing_count").alias("missing_rate_train"),
            _missing_rate("nw_count", "nw_missing").alias("missing_rate_infer")))
    absent = [f for f in features if f not in new.columns]
    if absent:
        parts.append(_absent_rows(train, absent, "categorical"))
    return _union(parts)


# ------------------------------------------------------------------ K13
def drift_report(train: DataFrame, new: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 bins: int = DEFAULT_BINS, k: int = DEFAULT_MAX_CATEGORIES, warn: float = PSI_WARN,
                 fail: float | None = PSI_FAIL, strict: bool = False) -> DataFrame:
    """One row per feature: feature, kind, psi, ks, status, missing_rate_train, missing_rate_infer."""
    parts = []
    if numeric:
        parts.append(drift_numeric(train, new, numeric, bins, warn, fail, strict))
    if categorical:
        parts.append(drift_categorical(train, new, categorical, k, warn, fail, strict))
    return _union(parts)


# ------------------------------------------------------------------ K10
def drift_summary(report: DataFrame, warn: float = PSI_WARN, fail: float | None = PSI_FAIL, strict: bool = False) -> DataFrame:
    """1-row roll-up of a drift report (feature lists sorted, comma-joined)."""
    present = F.col("status") != "missing"
    psi_ok = present & F.col("psi").isNotNull()
    warned = psi_ok & (F.col("psi") >= warn)
    failed = psi_ok & F.lit(bool(strict and fail is not None)) & (F.col("psi") >= F.lit(fail if fail is not None else 0.0))

    def names(cond):
        return F.concat_ws(",", F.array_sort(F.collect_list(F.when(cond, F.col("feature")))))

    return report.agg(
        F.count(F.lit(1)).alias("features_total"),
        F.max(F.when(psi_ok, F.col("psi"))).alias("psi_max"),
        F.avg(F.when(psi_ok, F.col("psi"))).alias("psi_mean"),
        F.max(F.when(present, F.col("ks"))).alias("ks_max"),
        F.avg(F.when(present, F.col("ks"))).alias("ks_mean"),
        F.count_if(warned).alias("warn_count"),
        F.count_if(failed).alias("fail_count"),
        F.count_if(~present).alias("missing_count"),
        names(warned).alias("warned_features"),
        names(failed).alias("failed_features"),
        names(~present).alias("missing_features"),
    )


# ------------------------------------------------------------------ K11
def drift_top_features(report: DataFrame, n: int = 10) -> DataFrame:
    """Top-n features by psi (by ks when no psi exists), carrying the other metric."""
    has_psi = report.where(F.col("psi").isNotNull()).limit(1).count() > 0
    metric = "psi" if has_psi else "ks"
    return (report.where(F.col(metric).isNotNull())
            .orderBy(F.col(metric).desc(), F.col("feature").asc()).limit(n)
            .select("feature", "kind", "psi", "ks", "status", F.lit(metric).alias("metric")))
