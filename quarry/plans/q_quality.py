"""Quality and leakage queries (D*) on LEAK (REG plus leak columns and 2 %
duplicated rows), TEXTY (mixed types) and CLS (classification mapping)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import quality as D
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, leak, texty, with_views


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


LEAK_COLS = ["row_id", "record_id", "quantity", "discount", "tax", "returnflag", "linestatus", "target",
             "leak_exact", "leak_noisy", "leak_scaled", "const_col"]
IDS = ["record_id"]

_NC = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {i} AS position, count(*) - count({c}) AS null_count,
        (count(*) - count({c}))::DOUBLE / count(*) AS missing_rate FROM leak""" for i, c in enumerate(LEAK_COLS))


@register("dq_missing", Q(["leak"], f""", m AS ({_NC})
SELECT "column", CAST(position AS BIGINT) AS position, CAST(null_count AS BIGINT) AS null_count, missing_rate FROM m
ORDER BY missing_rate DESC, position LIMIT 10""", "missing_rate"))
def q_dq_missing(spark, sf_dir):
    """Top-10 columns by missing rate."""
    return D.dq_missing(leak(spark, sf_dir))


@register("dq_duplicates", Q(["leak"], f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates, sum(n - 1)::DOUBLE / sum(n) AS duplicates_rate
FROM (SELECT count(*) AS n FROM leak GROUP BY {', '.join(LEAK_COLS)})""", "duplicates_rate"))
def q_dq_dup(spark, sf_dir):
    """Duplicate rows (NULL equals NULL)."""
    return D.dq_duplicates(leak(spark, sf_dir))


_CARD = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {i} AS position, count(DISTINCT CAST({c} AS VARCHAR)) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS unique_count,
        count(*) AS rows, count(*) - count({c}) AS nulls FROM leak""" for i, c in enumerate(LEAK_COLS))
_CARD_CTE = f""", card AS (SELECT "column", CAST(position AS BIGINT) AS position, CAST(unique_count AS BIGINT) AS unique_count,
  unique_count::DOUBLE / rows AS unique_ratio, nulls::DOUBLE / rows AS missing_rate FROM ({_CARD}))
"""


@register("dq_cardinality", Q(["leak"], _CARD_CTE + "SELECT * FROM card", "unique_ratio", "missing_rate"))
def q_dq_card(spark, sf_dir):
    """Unique count (NULL counts as a value), ratio and missing rate per column."""
    return D.dq_cardinality(leak(spark, sf_dir)).drop("dtype")


@register("dq_constant", Q(["leak"], _CARD_CTE + 'SELECT "column" FROM card WHERE unique_count <= 1'))
def q_dq_const(spark, sf_dir):
    """D3: constant columns."""
    return D.dq_constant(leak(spark, sf_dir))


@register("dq_id_like", Q(["leak"], _CARD_CTE + """
SELECT "column", unique_count, unique_ratio, missing_rate, "column" = 'record_id' AS declared_id FROM card
WHERE "column" <> 'target' AND unique_count >= 20 AND unique_ratio >= 0.98""", "unique_ratio", "missing_rate"))
def q_dq_id(spark, sf_dir):
    """Id-like columns."""
    return D.dq_id_like(leak(spark, sf_dir), "target", IDS)


@register("dq_high_cardinality", Q(["leak"], _CARD_CTE + """
SELECT "column", unique_count, unique_ratio, missing_rate, "column" = 'record_id' AS declared_id FROM card
WHERE "column" IN ('row_id', 'record_id', 'returnflag', 'linestatus', 'const_col') AND unique_count >= 20 AND unique_ratio >= 0.8""",
                                       "unique_ratio", "missing_rate"))
def q_dq_hc(spark, sf_dir):
    """High-cardinality non-numeric / integer columns."""
    return D.dq_high_cardinality(leak(spark, sf_dir), "target", IDS)


_TX = ["num_txt", "date_txt", "bool_txt", "int_txt", "pad_txt", "status_txt"]


@register("dq_mixed_types", Q(["texty"], f""",
lf AS (SELECT feature, trim(value) AS v FROM (SELECT {', '.join(_TX)} FROM texty) UNPIVOT (value FOR feature IN ({', '.join(_TX)}))),
b AS (SELECT feature AS "column", CASE WHEN lower(v) IN ('true', 'false') THEN 'bool'
                                       WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 'number'
                                       WHEN TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'string' END AS bucket
      FROM lf),
c AS (SELECT "column", bucket, count(*) AS count FROM b GROUP BY ALL)
SELECT * FROM c WHERE "column" IN (SELECT "column" FROM c GROUP BY "column" HAVING count(*) > 1)"""))
def q_dq_mixed(spark, sf_dir):
    """String columns mixing bool / number / datetime / text values."""
    return D.dq_mixed_types(texty(spark, sf_dir).drop("row_id", "l_shipdate"))


@register("dq_name_suspects", Q(["leak"], """
SELECT "column", kind, patterns, declared_id, unique_count FROM (VALUES ('row_id', 'id_suspect', 'id', FALSE), ('record_id', 'id_suspect', 'id', TRUE))
  v("column", kind, patterns, declared_id) JOIN (SELECT 'row_id' AS c, count(DISTINCT row_id) AS unique_count FROM leak
  UNION ALL SELECT 'record_id', count(DISTINCT record_id) FROM leak) ON c = "column\""""))
def q_dq_names(spark, sf_dir):
    """Column names matching leak / id patterns, with the cardinality that tells real ids."""
    df = leak(spark, sf_dir)
    found = D.dq_name_suspects(df, "target", ids=IDS)
    return found.join(D.dq_cardinality(df).select("column", "unique_count"), "column")


_NUMF = ["quantity", "discount", "tax", "leak_exact", "leak_noisy", "leak_scaled"]
_MATCH = " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", bool_and({c} IS NOT DISTINCT FROM target) AS exact,
         avg(CASE WHEN {c} IS NOT DISTINCT FROM target THEN 1.0 ELSE 0.0 END) AS match_rate FROM leak""" for c in _NUMF]
    + [f"""SELECT '{c}', FALSE, 0.0""" for c in ["row_id", "returnflag", "linestatus", "const_col"]])


@register("dq_leak_exact", Q(["leak"], f", m AS ({_MATCH}) SELECT \"column\", exact, match_rate FROM m WHERE exact", "match_rate"))
def q_dq_exact(spark, sf_dir):
    """Features identical to the target (error)."""
    return D.dq_leak_match(leak(spark, sf_dir), "target", IDS).where("exact").select("column", "exact", "match_rate")


@register("dq_leak_near_match", Q(["leak"], f", m AS ({_MATCH}) SELECT \"column\", exact, match_rate FROM m WHERE NOT exact AND match_rate >= 0.98",
                                      "match_rate"))
def q_dq_near(spark, sf_dir):
    """Features equal to the target in at least 98 % of rows (warning)."""
    return D.dq_leak_match(leak(spark, sf_dir), "target", IDS).where(~F.col("exact")).select("column", "exact", "match_rate")


_CORR = " UNION ALL ".join(f"""SELECT '{c}' AS "column", corr({c}, target) AS corr, count({c} + target) AS n FROM leak""" for c in _NUMF)


@register("dq_leak_correlation", Q(["leak"], f""", c AS ({_CORR})
SELECT "column", corr, abs(corr) >= 0.98 AS flagged FROM c WHERE n >= 2 AND corr IS NOT NULL AND NOT isnan(corr)
ORDER BY abs(corr) DESC, "column" LIMIT 5""", "corr"))
def q_dq_corr(spark, sf_dir):
    """Top-5 |Pearson| of numeric features with the target."""
    return D.dq_leak_correlation(leak(spark, sf_dir), "target", IDS)


_CLSF = ["totalprice", "priority", "segment", "cname", "acctbal", "nationkey", "orderdate", "label"]
_MAP = " UNION ALL ".join(f"""SELECT '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), '__MISSING__') AS value,
  coalesce(status, '__MISSING__') AS t FROM cls""" for c in _CLSF)


@register("dq_leak_mapping", Q(["cls"], f""", lf AS ({_MAP}),
vt AS (SELECT feature, value, t, count(*) AS n FROM lf GROUP BY ALL),
v AS (SELECT feature, value, max(n) AS mx, count(*) AS nt, sum(n) AS rows FROM vt GROUP BY feature, value)
SELECT feature AS "column", sum(mx)::DOUBLE / sum(rows) AS accuracy, max(nt) <= 1 AS deterministic, count(*) AS unique_values,
       (max(nt) <= 1) OR (sum(mx)::DOUBLE / sum(rows) >= 0.98) AS suspect
FROM v GROUP BY feature""", "accuracy"))
def q_dq_mapping(spark, sf_dir):
    """How well each CLS feature alone maps to the order status."""
    return D.dq_leak_mapping(cls(spark, sf_dir), "status", ["row_id"])


_STR_COLS = ["row_id", "record_id", "returnflag", "linestatus", "const_col"]
_NUM_CORR = " UNION ALL ".join(f"""SELECT '{c}' AS "column", corr({c}, target) AS corr, count({c} + target) AS n FROM leak""" for c in _NUMF)
_RULES = _CARD_CTE + f""",
tot AS (SELECT count(*) AS rows, ({' + '.join(f'(count(*) - count({c}))' for c in LEAK_COLS)}) AS nulls FROM leak),
dup AS (SELECT sum(n - 1) AS dups, sum(n - 1)::DOUBLE / sum(n) AS dr FROM (SELECT count(*) AS n FROM leak GROUP BY {', '.join(LEAK_COLS)})),
mx AS (SELECT count(*) AS n FROM (
  SELECT feature FROM (SELECT feature, CASE WHEN lower(trim(value)) IN ('true', 'false') THEN 'bool'
                                             WHEN TRY_CAST(trim(value) AS DOUBLE) IS NOT NULL THEN 'number'
                                             WHEN TRY_CAST(trim(value) AS TIMESTAMP) IS NOT NULL THEN 'datetime' ELSE 'string' END AS b
                       FROM (SELECT {', '.join(_STR_COLS)} FROM leak) UNPIVOT (value FOR feature IN ({', '.join(_STR_COLS)})))
  GROUP BY feature HAVING count(DISTINCT b) > 1)),
mt AS ({_MATCH}),
cr AS ({_NUM_CORR}),
lk AS (SELECT (SELECT count(*) FROM mt WHERE exact) AS e,
              (SELECT count(*) FROM mt WHERE NOT exact AND match_rate >= 0.98)
              + (SELECT count(*) FROM cr WHERE n >= 2 AND corr IS NOT NULL AND NOT isnan(corr) AND abs(corr) >= 0.98) AS w),
hc AS (SELECT count(*) AS n, count(*) FILTER (WHERE unique_ratio >= 1.01) AS f FROM card
       WHERE "column" IN ('row_id', 'record_id', 'returnflag', 'linestatus', 'const_col') AND unique_count >= 20 AND unique_ratio >= 0.8),
il AS (SELECT count(*) AS n, count(*) FILTER (WHERE unique_ratio >= 1.01) AS f FROM card
       WHERE "column" <> 'target' AND unique_count >= 20 AND unique_ratio >= 0.98),
cn AS (SELECT count(*) AS n FROM card WHERE unique_count <= 1),
rules0 AS (
  SELECT 'missing_rate' AS type, CASE WHEN nulls / (rows * {len(LEAK_COLS)}.0) >= 0.5 THEN 'fail'
                                      WHEN nulls / (rows * {len(LEAK_COLS)}.0) >= 0.2 THEN 'warn' END AS severity, CAST(1 AS BIGINT) AS count FROM tot
  UNION ALL SELECT 'duplicates', CASE WHEN dr >= 0.05 THEN 'fail' WHEN dr >= 0.01 THEN 'warn' END, CAST(CASE WHEN dups > 0 THEN dups ELSE 1 END AS BIGINT) FROM dup
  UNION ALL SELECT 'constant_columns', CASE WHEN n = 0 THEN NULL WHEN n >= 5 THEN 'fail' ELSE 'warn' END, n FROM cn
  UNION ALL SELECT 'mixed_type_columns', CASE WHEN n = 0 THEN NULL WHEN n >= 5 THEN 'fail' ELSE 'warn' END, n FROM mx
  UNION ALL SELECT 'high_cardinality', CASE WHEN n = 0 THEN NULL WHEN f > 0 OR n >= 9999 THEN 'fail' ELSE 'warn' END, n FROM hc
  UNION ALL SELECT 'id_like', CASE WHEN n = 0 THEN NULL WHEN f > 0 THEN 'fail' ELSE 'warn' END, n FROM il
  UNION ALL SELECT 'name_suspect', 'warn', CAST(2 AS BIGINT)
  UNION ALL SELECT 'leak', CASE WHEN e > 0 THEN 'fail' END, e FROM lk
  UNION ALL SELECT 'leak', CASE WHEN w > 0 THEN 'warn' END, w FROM lk),
rules AS (SELECT type, severity, CAST(count AS BIGINT) AS count FROM rules0 WHERE severity IS NOT NULL)
"""


@register("dq_evaluate", Q(["leak"], _RULES + "SELECT * FROM rules"))
def q_dq_eval(spark, sf_dir):
    """Rule table (type, severity, count) for LEAK."""
    return D.dq_evaluate(leak(spark, sf_dir), "target", "regression", IDS)


@register("dq_summary", Q(["leak"], _RULES + f"""
SELECT tot.rows, CAST({len(LEAK_COLS)} AS BIGINT) AS columns,
       CAST(({' + '.join(f'(CASE WHEN (SELECT count(*) - count({c}) FROM leak) > 0 THEN 1 ELSE 0 END)' for c in LEAK_COLS)}) AS BIGINT) AS missing_columns,
       (SELECT max(missing_rate) FROM card) AS missing_rate_max,
       CAST((SELECT dups FROM dup) AS BIGINT) AS duplicates_count, (SELECT n FROM hc) AS high_cardinality_count,
       (SELECT n FROM il) AS id_like_count, (SELECT n FROM mx) AS mixed_type_count, CAST(2 AS BIGINT) AS name_suspect_count,
       CAST((SELECT e + w FROM lk) AS BIGINT) AS leak_suspect_count, (SELECT e > 0 FROM lk) AS leak_error,
       CASE WHEN (SELECT count(*) FROM rules WHERE severity = 'fail') > 0 THEN 'fail'
            WHEN (SELECT count(*) FROM rules) > 0 THEN 'warn' ELSE 'pass' END AS quality_status,
       CAST((SELECT coalesce(sum(count), 0) FROM rules) AS BIGINT) AS quality_issue_count
FROM tot""", "missing_rate_max"))
def q_dq_summary(spark, sf_dir):
    """One-row quality roll-up for LEAK."""
    return D.dq_summary(leak(spark, sf_dir), "target", "regression", IDS)
