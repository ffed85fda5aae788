"""Profiling (C*), schema (B*) and scalar (M*) queries on REG, CLS, TEXTY, events."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import scalars as M
from quarry.functions.hashing import sql_hash_unit
from quarry.functions.ranking import long_form
from quarry.operators import profile as C
from quarry.operators import schema as B
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, pred_r, reg, table, texty, with_views


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


REG_COLS = ["row_id", "l_orderkey", "l_suppkey", "l_shipdate", "quantity", "discount", "tax", "price",
            "returnflag", "linestatus", "target"]
REG_NUM = ["quantity", "discount", "tax", "price"]
_NULLS = " + ".join(f"(count(*) - count({c}))" for c in REG_COLS)
_NCOLS_NULL = " + ".join(f"(CASE WHEN count(*) - count({c}) > 0 THEN 1 ELSE 0 END)" for c in REG_COLS)


@register("table_summary", Q(["reg"], f"""
SELECT count(*) AS rows, CAST({len(REG_COLS)} AS BIGINT) AS columns, CAST({_NULLS} AS BIGINT) AS missing_total,
       ({_NULLS}) / (count(*) * {len(REG_COLS)})::DOUBLE AS missing_rate, CAST({_NCOLS_NULL} AS BIGINT) AS missing_columns FROM reg""",
                                "missing_rate"))
def q_table_summary(spark, sf_dir):
    """C1 on REG."""
    return C.table_summary(reg(spark, sf_dir))


@register("profile_summary", Q(["reg"], f"""
SELECT count(*) AS rows, CAST({len(REG_COLS)} AS BIGINT) AS columns, CAST({_NULLS} AS BIGINT) AS missing_total,
       ({_NULLS}) / (count(*) * {len(REG_COLS)})::DOUBLE AS missing_rate, CAST({_NCOLS_NULL} AS BIGINT) AS missing_columns,
       CAST(6 AS BIGINT) AS numeric_features, CAST(3 AS BIGINT) AS categorical_features FROM reg""", "missing_rate"))
def q_profile_summary(spark, sf_dir):
    """C2 on REG (target and row id excluded from the feature counts)."""
    return C.profile_summary(reg(spark, sf_dir), target="target", ids=["row_id"])


_MISS_ROWS = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", (count(*) - count({c}))::DOUBLE / count(*) AS missing_rate FROM reg""" for c in REG_COLS)


@register("missingness_by_column", Q(["reg"], f""", m AS ({_MISS_ROWS}) SELECT * FROM m ORDER BY missing_rate DESC, "column" LIMIT 30""",
                                        "missing_rate"))
def q_missingness(spark, sf_dir):
    """C3 on REG (top 30 columns by missing rate)."""
    return C.missingness_by_column(reg(spark, sf_dir), 30)


def _hist_sql(src: str, cols, bins: int) -> str:
    unp = f"(SELECT feature, value FROM (SELECT {', '.join(cols)} FROM {src}) UNPIVOT (value FOR feature IN ({', '.join(cols)})))"
    return f""",
lf AS {unp},
rg AS (SELECT feature, CASE WHEN min(value) = max(value) THEN min(value) - 0.5 ELSE min(value) END AS lo,
              CASE WHEN min(value) = max(value) THEN max(value) + 0.5 ELSE max(value) END AS hi FROM lf GROUP BY feature)
SELECT feature, bin, lo + bin * (hi - lo) / {bins} AS lo, lo + (bin + 1) * (hi - lo) / {bins} AS hi, count FROM (
  SELECT l.feature, CAST(least(floor((value - lo) * {bins} / (hi - lo)), {bins - 1}) AS BIGINT) AS bin,
         any_value(lo) AS lo, any_value(hi) AS hi, count(*) AS count
  FROM lf l JOIN rg r ON l.feature = r.feature GROUP BY 1, 2)"""


@register("numeric_histogram", Q(["reg"], _hist_sql("reg", REG_NUM, 30), "lo", "hi"))
def q_numeric_hist(spark, sf_dir):
    """C4: 30 equal-width bins per numeric REG column."""
    return C.numeric_histogram(reg(spark, sf_dir), REG_NUM, 30)


CLS_CAT = ["priority", "segment", "cname"]


@register("categorical_topk", Q(["cls"], f""",
lf AS (SELECT feature, value FROM (SELECT {', '.join(CLS_CAT)} FROM cls) UNPIVOT (value FOR feature IN ({', '.join(CLS_CAT)}))),
c AS (SELECT feature, value, count(*) AS count FROM lf WHERE value IS NOT NULL GROUP BY ALL)
SELECT feature, value, count, rank FROM (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value) AS rank FROM c)
WHERE rank <= 10"""))
def q_cat_topk(spark, sf_dir):
    """Top-10 values of CLS categorical columns (incl. one value per customer name)."""
    return C.categorical_topk(cls(spark, sf_dir), CLS_CAT, 10)


@register("target_distribution", Q(["reg"], _hist_sql("reg", ["target"], 30).replace(
    "SELECT feature, bin, lo +", "SELECT feature, bin, CAST(NULL AS VARCHAR) AS value, lo +"), "lo", "hi"))
def q_target_dist(spark, sf_dir):
    """Numeric target -> histogram."""
    return C.target_distribution(reg(spark, sf_dir), "target")


@register("target_distribution_categorical", Q(["cls"], """
SELECT 'status' AS feature, rank AS bin, value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi, count FROM (
  SELECT status AS value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, status) AS rank
  FROM cls WHERE status IS NOT NULL GROUP BY status) WHERE rank <= 10""", "lo", "hi"))
def q_target_dist_cat(spark, sf_dir):
    """Categorical target -> top-k counts."""
    return C.target_distribution(cls(spark, sf_dir), "status")


def _processed(spark, sf_dir):
    r = reg(spark, sf_dir)
    return r.select("row_id", F.coalesce("quantity", F.lit(25.0)).alias("quantity"), "discount", "tax", "price",
                    "returnflag", "linestatus", "target")


_PROC_COLS = ["row_id", "quantity", "discount", "tax", "price", "returnflag", "linestatus"]
_FEAT_REG = [c for c in REG_COLS if c != "target"]
_RAW_NULLS = " + ".join(f"(count(*) - count({c}))" for c in _FEAT_REG)
_RAW_NC = " + ".join(f"(CASE WHEN count(*) - count({c}) > 0 THEN 1 ELSE 0 END)" for c in _FEAT_REG)


@register("profile_compare", Q(["reg"], f""",
s AS (SELECT count(*)::DOUBLE AS rows, ({_RAW_NULLS}) / (count(*) * {len(_FEAT_REG)})::DOUBLE AS mr, ({_RAW_NC})::DOUBLE AS mc FROM reg)
SELECT * FROM (VALUES ('rows', (SELECT rows FROM s), (SELECT rows FROM s)),
                      ('features', {float(len(_FEAT_REG))}, {float(len(_PROC_COLS))}),
                      ('numeric', 6.0, 4.0), ('categorical', 4.0, 3.0),
                      ('missing_rate', (SELECT mr FROM s), 0.0), ('missing_columns', (SELECT mc FROM s), 0.0)) v(metric, raw, processed)""",
                                  "raw", "processed"))
def q_profile_compare(spark, sf_dir):
    """Raw REG vs its imputed projection."""
    return C.profile_compare(reg(spark, sf_dir), _processed(spark, sf_dir), target="target")


@register("sample_rows", Q(["cls"], f"SELECT row_id, status, totalprice FROM cls ORDER BY {sql_hash_unit(0, 'row_id')}, row_id LIMIT 500",
                              "totalprice"))
def q_sample(spark, sf_dir):
    """Seeded 500-row sample of CLS (the sample size is the feature)."""
    return C.sample_rows(cls(spark, sf_dir).select("row_id", "status", "totalprice"), "row_id", 500, 0)


@register("quality_after_preprocess", Q(["reg"], f"""
SELECT CAST({_RAW_NULLS} AS BIGINT) AS missing_before, CAST(0 AS BIGINT) AS missing_after,
       CAST({_RAW_NULLS} AS BIGINT) AS missing_reduction, CAST({len(_FEAT_REG)} AS BIGINT) AS columns_before,
       CAST({len(_PROC_COLS)} AS BIGINT) AS columns_after, CAST({len(_FEAT_REG) - len(_PROC_COLS)} AS BIGINT) AS dropped_columns FROM reg"""))
def q_quality_after(spark, sf_dir):
    """C9."""
    return C.quality_after_preprocess(reg(spark, sf_dir), _processed(spark, sf_dir), target="target")


# ------------------------------------------------------------------ B
_REG_TYPES = [("row_id", "string"), ("l_orderkey", "bigint"), ("l_suppkey", "bigint"), ("l_shipdate", "timestamp_ntz"),
              ("quantity", "double"), ("discount", "double"), ("tax", "double"), ("price", "double"),
              ("returnflag", "string"), ("linestatus", "string"), ("target", "double")]
_TYPES_VALUES = ", ".join(f"('{c}', {i}, '{t}')" for i, (c, t) in enumerate(_REG_TYPES))


@register("infer_schema", Q(["reg"], f""",
n AS (SELECT count(*) AS rows, {', '.join(f'count(*) - count({c}) AS n_{c}' for c in REG_COLS)} FROM reg),
t AS (SELECT * FROM (VALUES {_TYPES_VALUES}) v("column", position, dtype))
SELECT t."column", CAST(t.position AS BIGINT) AS position, t.dtype, n.rows,
       CASE t."column" {' '.join(f"WHEN '{c}' THEN n_{c}" for c in REG_COLS)} END AS null_count,
       (CASE t."column" {' '.join(f"WHEN '{c}' THEN n_{c}" for c in REG_COLS)} END)::DOUBLE / n.rows AS null_rate
FROM t, n""", "null_rate"))
def q_infer_schema(spark, sf_dir):
    """B1 on REG."""
    return B.infer_schema(reg(spark, sf_dir))


@register("select_features", Q(["reg"], "SELECT l_orderkey, l_suppkey, quantity, discount, tax, price, returnflag, linestatus FROM reg",
                                  "quantity", "discount", "tax", "price"))
def q_select_features(spark, sf_dir):
    """REG minus target, row id and the time column."""
    return B.select_features(reg(spark, sf_dir), target="target", ids=["row_id"], drops=["l_shipdate"])


@register("feature_types", Q(["reg"], """
SELECT "column", kind, non_null, uniques FROM (VALUES ('l_orderkey', 'numeric'), ('l_suppkey', 'numeric'), ('l_shipdate', 'categorical'),
  ('quantity', 'numeric'), ('discount', 'numeric'), ('tax', 'numeric'), ('price', 'numeric'), ('returnflag', 'categorical'),
  ('linestatus', 'categorical')) v("column", kind) JOIN (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, count({c}) AS non_null, count(DISTINCT {c}) AS uniques FROM reg" for c in (
        "l_orderkey", "l_suppkey", "l_shipdate", "quantity", "discount", "tax", "price", "returnflag", "linestatus")) + """) ON c = "column\""""))
def q_feature_types(spark, sf_dir):
    """Numeric vs categorical partition of the REG features, with what each of them holds."""
    r = reg(spark, sf_dir)
    feats = [c for c in r.columns if c not in ("target", "row_id")]
    num, cat = B.feature_types(r.schema, feats)
    kinds = spark.createDataFrame([(c, "numeric") for c in num] + [(c, "categorical") for c in cat], "column string, kind string")
    held = long_form(r, [], feats, "string").groupBy("feature", "value").agg(F.count("value").alias("n")).groupBy("feature").agg(
        F.sum("n").alias("non_null"), F.count("value").alias("uniques"))
    return kinds.join(held, kinds["column"] == held["feature"]).drop("feature")


def _expected_texty():
    return T.StructType([T.StructField("row_id", T.StringType()), T.StructField("num_txt", T.DoubleType()),
                         T.StructField("date_txt", T.TimestampNTZType()), T.StructField("bool_txt", T.BooleanType()),
                         T.StructField("int_txt", T.LongType()), T.StructField("qty_missing", T.DoubleType())])


@register("schema_diff", Q(["texty"], """
SELECT issue, "column", expected, actual, coalesce(non_null, 0) AS non_null FROM (VALUES
  ('missing_column', 'qty_missing', 'double', NULL), ('extra_column', 'l_shipdate', NULL, 'timestamp_ntz'),
  ('extra_column', 'pad_txt', NULL, 'string'), ('extra_column', 'status_txt', NULL, 'string'),
  ('dtype_mismatch', 'num_txt', 'double', 'string'), ('dtype_mismatch', 'date_txt', 'timestamp_ntz', 'string'),
  ('dtype_mismatch', 'bool_txt', 'boolean', 'string'), ('dtype_mismatch', 'int_txt', 'bigint', 'string')
) v(issue, "column", expected, actual) LEFT JOIN (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS c, count({c}) AS non_null FROM texty" for c in ("l_shipdate", "pad_txt", "status_txt", "num_txt", "date_txt", "bool_txt", "int_txt")) + """) ON c = "column\""""))
def q_schema_diff(spark, sf_dir):
    """TEXTY's schema against the expected typed schema, with the values each issue touches."""
    t = texty(spark, sf_dir)
    diff = B.schema_diff_df(spark, t.schema, _expected_texty())
    held = long_form(t, [], t.columns, "string").groupBy("feature").agg(F.count("value").alias("non_null"))
    return diff.join(held, diff["column"] == held["feature"], "left").drop("feature").fillna(0, ["non_null"])


@register("coerce_numeric", Q(["texty"], """
SELECT row_id, num_txt, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS num
FROM (SELECT row_id, num_txt, TRY_CAST(trim(num_txt) AS DOUBLE) AS v FROM texty)""", "num"))
def q_coerce_numeric(spark, sf_dir):
    """Text to double; junk and NaN to NULL."""
    return texty(spark, sf_dir).select("row_id", "num_txt", B.coerce_numeric("num_txt").alias("num"))


@register("coerce_datetime", Q(["texty"], """
SELECT row_id, date_txt, strftime(TRY_CAST(trim(date_txt) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts FROM texty"""))
def q_coerce_datetime(spark, sf_dir):
    """Text to timestamp; invalid dates to NULL (rendered as text)."""
    t = texty(spark, sf_dir)
    return t.select("row_id", "date_txt",
                    F.date_format((F.trim("date_txt")).try_cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("ts"))


_BOOL_SQL = """CASE WHEN lower(trim(bool_txt)) IN ('true', '1', 'yes', 'y', 't') THEN TRUE
                 WHEN lower(trim(bool_txt)) IN ('false', '0', 'no', 'n', 'f') THEN FALSE END"""


@register("coerce_bool", Q(["texty"], f"SELECT row_id, bool_txt, {_BOOL_SQL} AS flag FROM texty"))
def q_coerce_bool(spark, sf_dir):
    """Text to boolean; unknown tokens to NULL."""
    return texty(spark, sf_dir).select("row_id", "bool_txt", B.coerce_bool("bool_txt", T.StringType()).alias("flag"))


_FAIL_SQL = f""",
f AS (SELECT row_id, 'num_txt' AS "column", 'numeric_coerce_failed' AS reason FROM texty
        WHERE num_txt IS NOT NULL AND (TRY_CAST(trim(num_txt) AS DOUBLE) IS NULL OR isnan(TRY_CAST(trim(num_txt) AS DOUBLE)))
      UNION ALL SELECT row_id, 'date_txt', 'datetime_coerce_failed' FROM texty
        WHERE date_txt IS NOT NULL AND TRY_CAST(trim(date_txt) AS TIMESTAMP) IS NULL
      UNION ALL SELECT row_id, 'bool_txt', 'bool_coerce_failed' FROM texty WHERE bool_txt IS NOT NULL AND ({_BOOL_SQL}) IS NULL
      UNION ALL SELECT row_id, 'int_txt', 'numeric_coerce_failed' FROM texty
        WHERE int_txt IS NOT NULL AND TRY_CAST(trim(int_txt) AS DOUBLE) IS NULL)
"""


@register("coerce_failures", Q(["texty"], _FAIL_SQL + 'SELECT row_id, "column", reason FROM f'))
def q_coerce_failures(spark, sf_dir):
    """Every value that fails to coerce to the expected type."""
    exp = {f.name: f.dataType.simpleString() for f in _expected_texty().fields}
    return B.coerce_failures(texty(spark, sf_dir), "row_id", exp)


@register("align_columns", Q(["texty"], """
SELECT row_id, num_txt, date_txt, bool_txt, int_txt, NULL::DOUBLE AS qty_missing FROM texty""", "qty_missing"))
def q_align(spark, sf_dir):
    """Keep the fitted columns in order, add absent ones as typed NULLs."""
    t = texty(spark, sf_dir)
    exp = T.StructType([T.StructField(f.name, T.StringType() if f.name != "qty_missing" else T.DoubleType())
                        for f in _expected_texty().fields])
    return B.align_columns(t, exp, allow_missing=True)


@register("validate_input", Q(["texty"], _FAIL_SQL + """,
u AS (SELECT reason AS issue FROM f UNION ALL SELECT * FROM (VALUES ('missing_column'), ('extra_column'), ('extra_column'), ('extra_column')) v(issue))
SELECT issue, count(*) AS count FROM u GROUP BY issue"""))
def q_validate(spark, sf_dir):
    """B11 (coerce mode): issue counts after casting TEXTY to the expected schema."""
    _, issues, _, _, _ = B.validate_input(texty(spark, sf_dir), _expected_texty(), "row_id", mode="coerce")
    return issues.groupBy("issue").agg(F.count(F.lit(1)).alias("count"))


@register("merge_issues", Q(["texty"], _FAIL_SQL + """,
u AS (SELECT reason AS issue FROM f UNION ALL SELECT * FROM (VALUES ('missing_column'), ('extra_column'), ('extra_column'), ('extra_column')) v(issue))
SELECT issue, count(*) AS count FROM u GROUP BY issue"""))
def q_merge(spark, sf_dir):
    """Issues of two chunks (shipped before / from 1998) folded into one set."""
    t = texty(spark, sf_dir)
    cut = F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    parts = []
    for chunk in (t.where(F.col("l_shipdate") < cut), t.where(F.col("l_shipdate") >= cut)):
        _, issues, _, _, _ = B.validate_input(chunk, _expected_texty(), "row_id", mode="coerce")
        parts.append(issues)
    return B.merge_issues(parts)


@register("rename_in_out", Q(["pred_r"], """
SELECT coalesce(a.row_id, b.row_id) AS row_id, a.quantity AS "in.quantity", a.discount AS "in.discount",
       b.y_pred AS "out.y_pred"
FROM (SELECT row_id, quantity, discount FROM reg) a FULL OUTER JOIN (SELECT row_id, y_pred FROM pred_r) b ON a.row_id = b.row_id""",
                                "\"in.quantity\"", "\"in.discount\"", "\"out.y_pred\""))
def q_rename(spark, sf_dir):
    """Input and output side by side (in./out. prefixes, outer join on row id)."""
    return B.rename_in_out(reg(spark, sf_dir).select("row_id", "quantity", "discount"),
                           pred_r(spark, sf_dir).select("row_id", "y_pred"))


# ------------------------------------------------------------------ M
@register("to_float_finite", Q(["texty"], """
SELECT row_id, CASE WHEN isnan(v) OR isinf(v) THEN NULL ELSE v END AS value
FROM (SELECT row_id, TRY_CAST(trim(num_txt) AS DOUBLE) AS v FROM texty)""", "value"))
def q_m1(spark, sf_dir):
    """M1."""
    return texty(spark, sf_dir).select("row_id", M.to_float_finite("num_txt").alias("value"))


@register("to_int_safe", Q(["texty"], "SELECT row_id, coalesce(TRY_CAST(trim(int_txt) AS BIGINT), CAST(-1 AS BIGINT)) AS value FROM texty"))
def q_m2(spark, sf_dir):
    """M2 (default -1)."""
    return texty(spark, sf_dir).select("row_id", M.to_int_safe("int_txt", -1).alias("value"))


@register("trim_or_null", Q(["texty"], "SELECT row_id, nullif(trim(pad_txt), '') AS value FROM texty"))
def q_m3(spark, sf_dir):
    """M3."""
    return texty(spark, sf_dir).select("row_id", M.trim_or_null("pad_txt").alias("value"))


@register("parse_bool_text", Q(["texty"], f"SELECT row_id, coalesce({_BOOL_SQL}, FALSE) AS value FROM texty"))
def q_m4(spark, sf_dir):
    """M4 (default false)."""
    return texty(spark, sf_dir).select("row_id", M.parse_bool_text("bool_txt").alias("value"))


@register("slugify", Q(["cls"], r"""
SELECT row_id, substr(coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(priority || ' ' || cname, '\s', '_', 'g'),
       '[^0-9A-Za-z_-]', '', 'g'), '^_+|_+$', '', 'g'), ''), 'col'), 1, 40) AS slug FROM cls"""))
def q_m5(spark, sf_dir):
    """M5 on order priority + customer name."""
    c = cls(spark, sf_dir)
    return c.select("row_id", M.slugify(F.concat_ws(" ", "priority", "cname")).alias("slug"))


@register("stringify_missing", Q(["reg"], "SELECT row_id, coalesce(CAST(quantity AS VARCHAR), '__MISSING__') AS value FROM reg"))
def q_m6(spark, sf_dir):
    """M6."""
    return reg(spark, sf_dir).select("row_id", M.stringify_missing("quantity").alias("value"))


@register("normalize_status", Q(["texty"], """
SELECT row_id, CASE WHEN t IN ('completed', 'closed', 'finished', 'published', 'success') THEN 'completed'
                    WHEN t IN ('failed', 'error') THEN 'failed' WHEN t IN ('stopped', 'aborted') THEN 'stopped'
                    WHEN t IN ('queued', 'created', 'pending') THEN 'queued' WHEN t IN ('in_progress', 'running') THEN 'running'
                    ELSE t END AS status
FROM (SELECT row_id, lower(trim(status_txt)) AS t FROM texty)"""))
def q_m9(spark, sf_dir):
    """M9."""
    return texty(spark, sf_dir).select("row_id", M.normalize_status("status_txt").alias("status"))
