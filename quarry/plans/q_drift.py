"""Drift queries (K*) on the DRIFT binding: REG rows shipped before the cut are
the train side, rows at or after the cut (with prices raised 30 %) the new side."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import drift as K
from quarry.plans.registry import register, rnd
from quarry.plans.views import reg, with_views

# Drift binding.
CUT = "1998-07-01"
PRICE_SHIFT = 1.3
NUM = ["quantity", "discount", "tax", "price"]
CAT = ["returnflag", "linestatus"]
BINS = K.DEFAULT_BINS


def drift_sides(spark, sf_dir):
    r = reg(spark, sf_dir)
    cut = F.expr(f"TIMESTAMP_NTZ '{CUT} 00:00:00'")
    train = r.where(F.col("l_shipdate") < cut)
    new = r.where(F.col("l_shipdate") >= cut).withColumn("price", F.col("price") * F.lit(PRICE_SHIFT))
    return train, new


_QS = "[" + ", ".join(repr(i / BINS) for i in range(BINS + 1)) + "]"
_NUM_IN = ", ".join(NUM)
_CAT_IN = ", ".join(CAT)

SQL_SIDES = with_views("reg") + f""",
dtrain AS (SELECT * FROM reg WHERE l_shipdate < TIMESTAMP '{CUT}'),
dnew AS (SELECT * REPLACE (price * {PRICE_SHIFT}::DOUBLE AS price) FROM reg WHERE l_shipdate >= TIMESTAMP '{CUT}'),
tl AS (SELECT feature, value FROM (SELECT {_NUM_IN} FROM dtrain) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_NUM_IN}))),
nl AS (SELECT feature, value FROM (SELECT {_NUM_IN} FROM dnew) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_NUM_IN}))),
tcl AS (SELECT feature, value FROM (SELECT {_CAT_IN} FROM dtrain) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_CAT_IN}))),
ncl AS (SELECT feature, value FROM (SELECT {_CAT_IN} FROM dnew) UNPIVOT INCLUDE NULLS (value FOR feature IN ({_CAT_IN}))),
eraw AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {_QS}))) AS e FROM tl WHERE value IS NOT NULL GROUP BY feature),
edges AS (SELECT feature, CASE WHEN len(e) = 1 THEN [e[1] - (CASE WHEN abs(e[1]) * 1e-6 = 0 THEN 1e-6 ELSE abs(e[1]) * 1e-6 END),
                                                   e[1] + (CASE WHEN abs(e[1]) * 1e-6 = 0 THEN 1e-6 ELSE abs(e[1]) * 1e-6 END)]
                                  ELSE e END AS edges FROM eraw),
grid AS (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM edges),
tb AS (SELECT l.feature, CASE WHEN value < edges[1] OR value > edges[len(edges)] THEN NULL
                              WHEN value = edges[len(edges)] THEN len(edges) - 2
                              ELSE len(list_filter(edges, lambda x: x <= value)) - 1 END AS bin
       FROM tl l JOIN edges e ON l.feature = e.feature WHERE value IS NOT NULL),
nb AS (SELECT l.feature, CASE WHEN value < edges[1] OR value > edges[len(edges)] THEN NULL
                              WHEN value = edges[len(edges)] THEN len(edges) - 2
                              ELSE len(list_filter(edges, lambda x: x <= value)) - 1 END AS bin
       FROM nl l JOIN edges e ON l.feature = e.feature WHERE value IS NOT NULL),
tcnt AS (SELECT g.feature, g.bin, coalesce(c.n, 0) AS count FROM grid g LEFT JOIN
         (SELECT feature, bin, count(*) AS n FROM tb WHERE bin IS NOT NULL GROUP BY ALL) c ON g.feature = c.feature AND g.bin = c.bin),
ncnt AS (SELECT g.feature, g.bin, coalesce(c.n, 0) AS count FROM grid g LEFT JOIN
         (SELECT feature, bin, count(*) AS n FROM nb WHERE bin IS NOT NULL GROUP BY ALL) c ON g.feature = c.feature AND g.bin = c.bin),
nbk AS (SELECT t.feature, t.bin, t.count::DOUBLE AS e, n.count::DOUBLE AS a FROM tcnt t JOIN ncnt n ON t.feature = n.feature AND t.bin = n.bin),
nsh AS (SELECT *, sum(e) OVER (PARTITION BY feature) AS se, sum(a) OVER (PARTITION BY feature) AS sa FROM nbk),
nsh2 AS (SELECT *, greatest(e / nullif(se, 0), 1e-6) AS es, greatest(a / nullif(sa, 0), 1e-6) AS as_,
                sum(e / nullif(se, 0)) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ce,
                sum(a / nullif(sa, 0)) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca
         FROM nsh),
npsi AS (SELECT feature, CASE WHEN first(se) > 0 AND first(sa) > 0 THEN sum((as_ - es) * ln(as_ / es)) END AS psi,
                CASE WHEN first(se) > 0 AND first(sa) > 0 THEN max(abs(ca - ce)) END AS ks
         FROM nsh2 GROUP BY feature),
tmiss AS (SELECT feature, count(value) AS c, count(*) FILTER (WHERE value IS NULL) AS m FROM tl GROUP BY feature),
nmiss AS (SELECT feature, count(value) AS c, count(*) FILTER (WHERE value IS NULL) AS m FROM nl GROUP BY feature),
numrep AS (SELECT p.feature, 'numeric' AS kind, psi, ks,
                  CASE WHEN psi IS NULL THEN 'n/a' WHEN psi >= 0.2 THEN 'warn' ELSE 'ok' END AS status,
                  CASE WHEN t.c + t.m <= 0 THEN 0.0 ELSE t.m / (t.c + t.m) END AS missing_rate_train,
                  CASE WHEN n.c + n.m <= 0 THEN 0.0 ELSE n.m / (n.c + n.m) END AS missing_rate_infer
           FROM npsi p JOIN tmiss t ON p.feature = t.feature JOIN nmiss n ON p.feature = n.feature),
ccnt AS (SELECT feature, value, count(*) AS count FROM tcl WHERE value IS NOT NULL GROUP BY ALL),
ctop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value ASC) AS rank FROM ccnt) WHERE rank <= 10),
ctot AS (SELECT feature, count(value) AS total, count(*) FILTER (WHERE value IS NULL) AS missing_count FROM tcl GROUP BY feature),
cprof AS (SELECT t.feature, t.rank, t.value, t.count, t.count / o.total AS rate, o.total, o.missing_count,
                 greatest(o.total - s.top, 0) AS other_count
          FROM ctop t JOIN ctot o ON t.feature = o.feature
          JOIN (SELECT feature, sum(count) AS top FROM ctop GROUP BY feature) s ON t.feature = s.feature),
nctot AS (SELECT feature, count(value) AS c, count(*) FILTER (WHERE value IS NULL) AS m FROM ncl GROUP BY feature),
ncc AS (SELECT feature, value, count(*) AS a FROM ncl WHERE value IS NOT NULL GROUP BY ALL),
cb AS (SELECT t.feature, t.value, t.count::DOUBLE AS e, coalesce(n.a, 0)::DOUBLE AS a FROM ctop t
       LEFT JOIN ncc n ON t.feature = n.feature AND t.value = n.value),
cball AS (SELECT * FROM cb
          UNION ALL
          SELECT o.feature, NULL AS value, greatest(o.total - s.se, 0)::DOUBLE AS e, greatest(n.c - s.sa, 0)::DOUBLE AS a
          FROM ctot o JOIN (SELECT feature, sum(e) AS se, sum(a) AS sa FROM cb GROUP BY feature) s ON o.feature = s.feature
          JOIN nctot n ON o.feature = n.feature),
csh AS (SELECT *, sum(e) OVER (PARTITION BY feature) AS se, sum(a) OVER (PARTITION BY feature) AS sa FROM cball),
cpsi AS (SELECT feature, CASE WHEN first(se) > 0 AND first(sa) > 0 THEN
                  sum((greatest(a / nullif(sa, 0), 1e-6) - greatest(e / nullif(se, 0), 1e-6))
                      * ln(greatest(a / nullif(sa, 0), 1e-6) / greatest(e / nullif(se, 0), 1e-6))) END AS psi
         FROM csh GROUP BY feature),
catrep AS (SELECT p.feature, 'categorical' AS kind, psi, NULL::DOUBLE AS ks,
                  CASE WHEN psi IS NULL THEN 'n/a' WHEN psi >= 0.2 THEN 'warn' ELSE 'ok' END AS status,
                  CASE WHEN t.total + t.missing_count <= 0 THEN 0.0 ELSE t.missing_count / (t.total + t.missing_count) END AS missing_rate_train,
                  CASE WHEN n.c + n.m <= 0 THEN 0.0 ELSE n.m / (n.c + n.m) END AS missing_rate_infer
           FROM cpsi p JOIN ctot t ON p.feature = t.feature JOIN nctot n ON p.feature = n.feature),
report AS (SELECT * FROM numrep UNION ALL SELECT * FROM catrep)
"""

_REP_D = ("psi", "ks", "missing_rate_train", "missing_rate_infer")


@register("profile_numeric", rnd(SQL_SIDES + """
SELECT m.feature, CAST(m.count AS BIGINT) AS count, CAST(m.missing_count AS BIGINT) AS missing_count, m.mean, m.std, m.min, m.max,
       q[1] AS p05, q[2] AS p25, q[3] AS p50, q[4] AS p75, q[5] AS p95
FROM (SELECT feature, count(value) AS count, count(*) FILTER (WHERE value IS NULL) AS missing_count, avg(value) AS mean,
             stddev_pop(value) AS std, min(value) AS min, max(value) AS max FROM tl GROUP BY feature) m
LEFT JOIN (SELECT feature, quantile_cont(value, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM tl WHERE value IS NOT NULL GROUP BY feature) qq
  ON m.feature = qq.feature""", "mean", "std", "min", "max", "p05", "p25", "p50", "p75", "p95"))
def q_profile_numeric(spark, sf_dir):
    """K1 on the train side."""
    train, _ = drift_sides(spark, sf_dir)
    return K.profile_numeric(train, NUM)


@register("hist_edges", rnd(SQL_SIDES + """
SELECT feature, CAST(i - 1 AS BIGINT) AS edge_index, edges[i] AS edge
FROM (SELECT feature, edges, unnest(range(1, len(edges) + 1)) AS i FROM edges)""", "edge"))
def q_hist_edges(spark, sf_dir):
    """K2: train quantile edges, one row per edge."""
    train, _ = drift_sides(spark, sf_dir)
    e = K.hist_edges(train, NUM, BINS)
    return e.select("feature", F.posexplode("edges").alias("edge_index", "edge"))


@register("hist_counts", SQL_SIDES + """
SELECT t.feature, CAST(t.bin AS BIGINT) AS bin, CAST(t.count AS BIGINT) AS train_count, CAST(n.count AS BIGINT) AS new_count
FROM tcnt t JOIN ncnt n ON t.feature = n.feature AND t.bin = n.bin""")
def q_hist_counts(spark, sf_dir):
    """K3: train and new counts on the train edges."""
    train, new = drift_sides(spark, sf_dir)
    e = K.hist_edges(train, NUM, BINS)
    tc = K.hist_counts(train, NUM, e).withColumnRenamed("count", "train_count")
    nc = K.hist_counts(new, NUM, e).withColumnRenamed("count", "new_count")
    return tc.join(nc, ["feature", "bin"])


@register("profile_categorical", rnd(SQL_SIDES + """
SELECT feature, CAST(rank AS BIGINT) AS rank, value, CAST(count AS BIGINT) AS count, rate,
       CAST(total AS BIGINT) AS total, CAST(missing_count AS BIGINT) AS missing_count, CAST(other_count AS BIGINT) AS other_count
FROM cprof""", "rate"))
def q_profile_categorical(spark, sf_dir):
    """K4 on the train side."""
    train, _ = drift_sides(spark, sf_dir)
    return K.profile_categorical(train, CAT)


@register("drift_psi_numeric", rnd(SQL_SIDES + "SELECT feature, psi FROM numrep", "psi"))
def q_drift_psi_numeric(spark, sf_dir):
    """K5."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_numeric(train, new, NUM).select("feature", "psi")


@register("drift_psi_categorical", rnd(SQL_SIDES + "SELECT feature, psi FROM catrep", "psi"))
def q_drift_psi_categorical(spark, sf_dir):
    """K6."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_categorical(train, new, CAT).select("feature", "psi")


@register("drift_ks", rnd(SQL_SIDES + "SELECT feature, ks FROM numrep", "ks"))
def q_drift_ks(spark, sf_dir):
    """K7."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_numeric(train, new, NUM).select("feature", "ks")


@register("drift_missing", rnd(SQL_SIDES + "SELECT feature, missing_rate_train, missing_rate_infer FROM report",
                               "missing_rate_train", "missing_rate_infer"))
def q_drift_missing(spark, sf_dir):
    """K8."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_report(train, new, NUM, CAT).select("feature", "missing_rate_train", "missing_rate_infer")


@register("drift_status", SQL_SIDES + "SELECT feature, kind, status FROM report")
def q_drift_status(spark, sf_dir):
    """K9."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_report(train, new, NUM, CAT).select("feature", "kind", "status")


@register("drift_summary", rnd(SQL_SIDES + """
SELECT CAST(count(*) AS BIGINT) AS features_total,
       max(psi) FILTER (WHERE status <> 'missing' AND psi IS NOT NULL) AS psi_max,
       avg(psi) FILTER (WHERE status <> 'missing' AND psi IS NOT NULL) AS psi_mean,
       max(ks) FILTER (WHERE status <> 'missing') AS ks_max,
       avg(ks) FILTER (WHERE status <> 'missing') AS ks_mean,
       CAST(count(*) FILTER (WHERE status <> 'missing' AND psi >= 0.2) AS BIGINT) AS warn_count,
       CAST(0 AS BIGINT) AS fail_count,
       CAST(count(*) FILTER (WHERE status = 'missing') AS BIGINT) AS missing_count,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status <> 'missing' AND psi >= 0.2), '') AS warned_features,
       '' AS failed_features,
       coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'missing'), '') AS missing_features
FROM report""", "psi_max", "psi_mean", "ks_max", "ks_mean"))
def q_drift_summary(spark, sf_dir):
    """K10."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_summary(K.drift_report(train, new, NUM, CAT))


@register("drift_top_features", rnd(SQL_SIDES + """
SELECT feature, kind, psi, ks, status, 'psi' AS metric FROM report WHERE psi IS NOT NULL
ORDER BY psi DESC, feature LIMIT 3""", "psi", "ks"))
def q_drift_top_features(spark, sf_dir):
    """Top-3 drifting features (the limit is the feature)."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_top_features(K.drift_report(train, new, NUM, CAT), 3)


@register("drift_report", rnd(SQL_SIDES + "SELECT * FROM report", *_REP_D))
def q_drift_report(spark, sf_dir):
    """The whole per-feature drift report (flagship query)."""
    train, new = drift_sides(spark, sf_dir)
    return K.drift_report(train, new, NUM, CAT)


def numeric_drift_sql(train_sql: str, new_sql: str, features: list[str], bins: int = BINS) -> str:
    """CTE chain (DuckDB) ending in ``ndrift(feature, psi, ks, status)`` for numeric
    drift of ``new_sql`` rows against ``train_sql`` rows."""
    qs = "[" + ", ".join(repr(i / bins) for i in range(bins + 1)) + "]"
    cols = ", ".join(features)
    binexpr = """CASE WHEN value < edges[1] OR value > edges[len(edges)] THEN NULL
                      WHEN value = edges[len(edges)] THEN len(edges) - 2
                      ELSE len(list_filter(edges, lambda x: x <= value)) - 1 END"""
    return f""",
ztl AS (SELECT feature, value FROM (SELECT {cols} FROM ({train_sql})) UNPIVOT INCLUDE NULLS (value FOR feature IN ({cols}))),
znl AS (SELECT feature, value FROM (SELECT {cols} FROM ({new_sql})) UNPIVOT INCLUDE NULLS (value FOR feature IN ({cols}))),
zer AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, {qs}))) AS e FROM ztl WHERE value IS NOT NULL GROUP BY feature),
zed AS (SELECT feature, CASE WHEN len(e) = 1 THEN [e[1] - (CASE WHEN abs(e[1]) * 1e-6 = 0 THEN 1e-6 ELSE abs(e[1]) * 1e-6 END),
                                                 e[1] + (CASE WHEN abs(e[1]) * 1e-6 = 0 THEN 1e-6 ELSE abs(e[1]) * 1e-6 END)]
                                ELSE e END AS edges FROM zer),
zgr AS (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM zed),
ztc AS (SELECT g.feature, g.bin, coalesce(c.n, 0)::DOUBLE AS e FROM zgr g LEFT JOIN
        (SELECT l.feature, {binexpr} AS bin, count(*) AS n FROM ztl l JOIN zed USING (feature) WHERE value IS NOT NULL GROUP BY ALL) c
        ON g.feature = c.feature AND g.bin = c.bin),
znc AS (SELECT g.feature, g.bin, coalesce(c.n, 0)::DOUBLE AS a FROM zgr g LEFT JOIN
        (SELECT l.feature, {binexpr} AS bin, count(*) AS n FROM znl l JOIN zed USING (feature) WHERE value IS NOT NULL GROUP BY ALL) c
        ON g.feature = c.feature AND g.bin = c.bin),
zbk AS (SELECT t.feature, t.bin, e, a, sum(e) OVER (PARTITION BY t.feature) AS se, sum(a) OVER (PARTITION BY t.feature) AS sa
        FROM ztc t JOIN znc n ON t.feature = n.feature AND t.bin = n.bin),
zsh AS (SELECT *, greatest(e / nullif(se, 0), 1e-6) AS es, greatest(a / nullif(sa, 0), 1e-6) AS as_,
               sum(e / nullif(se, 0)) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ce,
               sum(a / nullif(sa, 0)) OVER (PARTITION BY feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ca FROM zbk),
ndrift AS (SELECT feature, psi, ks, CASE WHEN psi IS NULL THEN 'n/a' WHEN psi >= 0.2 THEN 'warn' ELSE 'ok' END AS status FROM (
  SELECT feature, CASE WHEN first(se) > 0 AND first(sa) > 0 THEN sum((as_ - es) * ln(as_ / es)) END AS psi,
         CASE WHEN first(se) > 0 AND first(sa) > 0 THEN max(abs(ca - ce)) END AS ks FROM zsh GROUP BY feature))
"""
