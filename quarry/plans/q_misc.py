"""Source / sink (A*), model (G*) and streaming (L*) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit, sql_hash_unit
from quarry.functions.scalars import canonicalize_missing
from quarry.operators import models as G
from quarry.plans.q_drift import SQL_SIDES, drift_sides, NUM, CAT
from quarry.operators import drift as K
from quarry.plans import sql_models as M
from quarry.plans.q_prep import CLS_TRAIN, REG_TRAIN
from quarry.plans.registry import register, rnd
from quarry.plans.views import cls, reg, table, with_views
from quarry.session import scratch_path, stored
from quarry.sources import io as A
from quarry.streaming import scoring as L


def Q(views, body, *dbl):
    return rnd(with_views(*views) + body, *dbl)


@register("scan_parquet", rnd("""SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_returnflag = 'R'""",
                              "l_quantity"))
def q_scan_parquet(spark, sf_dir):
    """A1: projection + filter pushed into the Parquet scan."""
    return A.scan_parquet(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"],
                          (F.col("l_shipdate") >= F.expr("TIMESTAMP_NTZ '1998-01-01 00:00:00'")) & (F.col("l_returnflag") == "R"))


@register("scan_csv", Q(["reg"], "SELECT row_id, quantity, returnflag FROM reg", "quantity"))
def q_scan_csv(spark, sf_dir):
    """A2 + A13: REG columns written as CSV to shared storage and read back."""
    path = A.shared_scratch(spark, "csv")
    A.sink(reg(spark, sf_dir).select("row_id", "quantity", "returnflag"), path, "csv")
    return A.scan_csv(spark, path, "row_id string, quantity double, returnflag string")


@register("scan_json_records", Q(["cls"], "SELECT row_id, status, totalprice FROM cls", "totalprice"))
def q_scan_json(spark, sf_dir):
    """A4: CLS rows written as JSON records and read back."""
    path = A.shared_scratch(spark, "json")
    A.sink(cls(spark, sf_dir).select("row_id", "status", "totalprice"), path, "json")
    return A.scan_json_records(spark, path, "row_id bigint, status string, totalprice double")


@register("scan_directory", rnd("SELECT o_orderkey, o_totalprice FROM orders", "o_totalprice"))
def q_scan_dir(spark, sf_dir):
    """A3: every Parquet file below a folder (orders written as several files)."""
    path = A.shared_scratch(spark, "dir")
    A.sink(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").repartition(4), f"{path}/part_a")
    return A.scan_directory(spark, path)


@register("scan_limit", Q(["cls"], "SELECT row_id, status FROM cls ORDER BY row_id LIMIT 100"))
def q_scan_limit(spark, sf_dir):
    """A5: max_rows = 100 in row-id order (the cap is the feature)."""
    return A.scan_limit(cls(spark, sf_dir).select("row_id", "status"), 100, ["row_id"])


FINGERPRINT_SQL = """
SELECT rows, content_hash, sha256(CAST(rows AS VARCHAR) || ':' || content_hash) AS fingerprint FROM (
  SELECT count(*) AS rows, CAST(sum(('0x' || substr(md5(concat_ws(chr(31), """ + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), chr(30))" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                                         "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")) + """)), 1, 15))::HUGEINT) AS VARCHAR) AS content_hash
  FROM lineitem)"""


@register("table_fingerprint", FINGERPRINT_SQL)
def q_fingerprint(spark, sf_dir):
    """Order-insensitive content fingerprint of lineitem."""
    return A.table_fingerprint(table(spark, sf_dir, "lineitem"))


@register("canonicalize_missing", Q(["reg"], "SELECT row_id, quantity, discount FROM reg", "quantity", "discount"))
def q_canon(spark, sf_dir):
    """NaN / Inf to NULL on every float column."""
    return canonicalize_missing(reg(spark, sf_dir).select("row_id", "quantity", "discount"))


@register("canonicalize_missing_odd", Q(["reg"], "SELECT row_id, CASE WHEN h < 4 THEN NULL ELSE quantity END AS x, discount FROM (SELECT *, " + sql_hash_unit(5, "row_id") + " % 9 AS h FROM reg)", "x", "discount"))
def q_canon_odd(spark, sf_dir):
    """A9 where the input has NaN, both infinities and nulls."""
    h = F.pmod(hash_unit(5, "row_id"), F.lit(9))
    x = F.when(h == 0, float("nan")).when(h == 1, float("inf")).when(h == 2, float("-inf")).when(h == 3, F.lit(None).cast("double")).otherwise(F.col("quantity"))
    return canonicalize_missing(reg(spark, sf_dir).select("row_id", x.alias("x"), "discount"))


@register("preview_head", Q(["reg"], "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM reg ORDER BY row_id LIMIT 5",
                             "quantity", "discount", "tax", "price", "target"))
def q_preview(spark, sf_dir):
    """First 5 rows by row id, at most 20 columns (timestamps as text)."""
    r = reg(spark, sf_dir)
    return A.preview_head(r, "row_id")


@register("join_xy", Q(["reg"], "SELECT row_id, quantity, discount, target FROM reg", "quantity", "discount", "target"))
def q_join_xy(spark, sf_dir):
    """Features and target tables joined back on the row id."""
    r = reg(spark, sf_dir)
    return A.join_xy(r.select("row_id", "quantity", "discount"), r.select("row_id", "target"))


@register("alert_rows", SQL_SIDES + """
SELECT '2024-01-01T00:00:00Z' AS timestamp, 'drift' AS kind, feature || ' is ' || s || ', psi=' || CAST(CAST(round(psi, 6) AS DECIMAL(18, 6)) AS VARCHAR) AS message,
       CASE WHEN s = 'fail' THEN 'error' ELSE 'warning' END AS severity, 'drift ' || s || ': ' || feature AS title, feature AS context
FROM (SELECT *, CASE WHEN psi >= 0.001 THEN 'fail' WHEN psi >= 0.00001 THEN 'warn' END AS s FROM report) WHERE s IS NOT NULL""")
def q_alerts(spark, sf_dir):
    """Alert rows for drifting features, at sensitive thresholds."""
    train, new = drift_sides(spark, sf_dir)
    report = K.drift_report(train, new, NUM, CAT, warn=0.00001, fail=0.001, strict=True)
    return A.alert_rows(report, "drift", value_col="psi", at="2024-01-01T00:00:00Z")


# ------------------------------------------------------------------ G
def _reg_train_features(spark, sf_dir):
    from quarry.plans.q_prep import reg_train
    return reg_train(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0))).withColumn(
        "is_r", F.when(F.col("returnflag") == "R", 1.0).otherwise(0.0))


#: REG train rows with a filled quantity and a return flag, and the same in SQL.
REG_FIT = REG_TRAIN + """, tf AS (SELECT *, coalesce(quantity, 25.0::DOUBLE) AS qf, CASE WHEN returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_r FROM tr),
"""
RF = ["qf", "discount", "is_r"]


def _fitted(sql: str) -> str:
    return Q(["reg"], REG_FIT + sql, "coefficient", "importance")


def _table(spark, fit, feats=RF):
    w, b = fit
    rows = [(f, float(v), abs(float(v))) for f, v in zip(feats, w)] + [("__intercept__", b, None)]
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double")


@register("fit_linear_regression", _fitted(M.gram("g", "tf", RF, "target") + ",\n" + M.solved("s", "g", 3, ["my", "m0", "m1", "m2"]) + "\n" + M.coefficient_rows("s", RF)))
def q_fit_ols(spark, sf_dir):
    """G1 + G17: OLS on the REG train rows; coefficient table."""
    return _table(spark, G.fit_linear_gram(_reg_train_features(spark, sf_dir), RF, "target", "ols"))


@register("fit_ols_single_feature", Q(["reg"], """,
f AS (SELECT coalesce(quantity, 25.0::DOUBLE) AS qf, target FROM reg)
SELECT * FROM (VALUES ('qf', (SELECT regr_slope(target, qf) FROM f), abs((SELECT regr_slope(target, qf) FROM f))),
                      ('__intercept__', (SELECT regr_intercept(target, qf) FROM f), NULL::DOUBLE)) v(feature, coefficient, importance)""",
                                         "coefficient", "importance"))
def q_fit_ols1(spark, sf_dir):
    """G1 with one feature over all REG rows: MLlib least squares against the closed form."""
    r = reg(spark, sf_dir).withColumn("qf", F.coalesce("quantity", F.lit(25.0)))
    return G.coefficients(G.fit_linear(r, ["qf"], "target", "ols"), ["qf"], spark)


@register("fit_ridge", _fitted(M.gram("g", "tf", RF, "target") + ",\n" + M.solved("s", "g", 3, ["my", "m0", "m1", "m2"], "1.0") + "\n" + M.coefficient_rows("s", RF)))
def q_fit_ridge(spark, sf_dir):
    """Ridge (alpha = 1) by MLlib's normal equations in the reference's scaling."""
    m = G.fit_linear(_reg_train_features(spark, sf_dir), RF, "target", "ridge", 1.0)
    return G.coefficients(m, RF, spark)


#: CLS train and all rows with standard-scaled price, balance and nation (train statistics).
CLS_FIT = CLS_TRAIN + """,
st AS (SELECT avg(totalprice) AS a0, stddev_pop(totalprice) AS s0, avg(acctbal) AS a1, stddev_pop(acctbal) AS s1, avg(nationkey) AS a2, stddev_pop(nationkey) AS s2 FROM ctr),
sc AS (SELECT row_id, label, segment, status, (totalprice - a0) / s0 AS f0, (acctbal - a1) / s1 AS f1, (nationkey - a2) / s2 AS f2 FROM cls, st),
tf AS (SELECT * FROM sc WHERE row_id IN (SELECT row_id FROM csp WHERE split = 'train')),
vf AS (SELECT * FROM sc WHERE row_id IN (SELECT row_id FROM csp WHERE split = 'val')),
"""
CF = ["totalprice", "acctbal", "nationkey"]


def cls_scaled(spark, sf_dir):
    """(train, validation) rows of CLS, scaled on train, as in CLS_FIT; ``fold`` is an md5 fold of 5."""
    from quarry.functions.hashing import hash_bucket
    from quarry.operators import splits as E
    from quarry.operators.preprocess import apply_scale, fit_scale
    from quarry.plans.q_prep import P_VAL, SEED
    c = stored(cls(spark, sf_dir).select("row_id", "label", "segment", "status", *CF))  # the join once; split, scaling and both sides read its rows
    sp = E.random_rule(c, "row_id", P_VAL, SEED)
    c = apply_scale(c, fit_scale(E.apply_split(c, sp, "row_id", "train"), CF, "standard")).withColumn("fold", hash_bucket(42, "row_id", 5))
    return E.apply_split(c, sp, "row_id", "train"), E.apply_split(c, sp, "row_id", "val")


@register("fit_logistic_regression", Q(["cls"], CLS_FIT + M.logistic("w", "tf", ["f0", "f1", "f2"], "label", 1.0) + "\n" + M.coefficient_rows("w", CF, 1, "b0"),
                                       "coefficient", "importance"))
def q_fit_logit(spark, sf_dir):
    """L2 logistic regression (C = 1) on scaled CLS price, balance and nation, by Newton steps."""
    coef = G.newton_logistic(cls_scaled(spark, sf_dir)[0], CF, "label", l2=1.0)[0][0]
    return _table(spark, (coef[1:], float(coef[0])), CF)


@register("fit_logistic_multinomial", Q(["cls"], CLS_TRAIN + """
SELECT segment, avg(CASE WHEN status = 'F' THEN 1.0 ELSE 0.0 END) AS p_F, avg(CASE WHEN status = 'O' THEN 1.0 ELSE 0.0 END) AS p_O,
       avg(CASE WHEN status = 'P' THEN 1.0 ELSE 0.0 END) AS p_P FROM ctr GROUP BY segment""", "p_F", "p_O", "p_P"))
def q_fit_softmax(spark, sf_dir):
    """G5 for three classes: softmax on the one-hot segment alone, whose likelihood is greatest at each segment's class shares."""
    from quarry.operators.preprocess import apply_onehot, fit_onehot
    from quarry.plans.q_prep import cls_train
    tr = stored(cls_train(spark, sf_dir).select("segment", "status"))
    cats = fit_onehot(tr, ["segment"])
    feats = [f"cat__segment_{v}" for v in cats["segment"]]
    y = F.when(F.col("status") == "F", 0).when(F.col("status") == "O", 1).otherwise(2)
    x = apply_onehot(tr.select("segment", y.alias("y")), cats)
    p = G.logistic_proba(G.newton_logistic(x, feats, "y", 3)[0], feats)
    return x.select("segment", *[e.alias(f"p_{c}") for e, c in zip(p, "FOP")]).dropDuplicates(["segment"])


@register("cross_validate_logistic", Q(["cls"], CLS_FIT + "".join(
    f"t{k} AS (SELECT * FROM tf WHERE {sql_hash_unit(42, 'row_id')} % 5 <> {k}),\n" + M.logistic(f"w{k}", f"t{k}", ["f0", "f1", "f2"], "label", 1.0, 7) + ",\n" for k in range(5))
    + "w AS (" + " UNION ALL ".join(f"SELECT {k} AS fold, * FROM w{k}" for k in range(5)) + f"""),
o AS (SELECT w.fold, label, 1 / (1 + exp(-(b0 + b1 * f0 + b2 * f1 + b3 * f2))) AS p FROM tf JOIN w ON {sql_hash_unit(42, 'row_id')} % 5 = w.fold),
m AS (SELECT fold::BIGINT AS fold, count(*) AS n, avg(CASE WHEN (p >= 0.5) = (label = 1) THEN 1.0 ELSE 0.0 END) AS accuracy,
             -avg(CASE WHEN label = 1 THEN ln(p) ELSE ln(1 - p) END) AS log_loss FROM o GROUP BY fold)
SELECT * FROM m UNION ALL SELECT -1, NULL, avg(accuracy), avg(log_loss) FROM m UNION ALL SELECT -2, NULL, stddev_pop(accuracy), stddev_pop(log_loss) FROM m""",
                                       "accuracy", "log_loss"))
def q_cv_logit(spark, sf_dir):
    """H21 for logistic regression: five fold fits in the same Newton steps, on train rows."""
    tr, _ = cls_scaled(spark, sf_dir)
    return G.cross_validate_logistic(tr.drop("fold"), tr.select("row_id", "fold"), "row_id", CF, "label", 5, 1.0)


@register("class_weights", Q(["cls"], """
SELECT status, count(*) AS n_c, (SELECT count(*) FROM cls)::DOUBLE / (3 * count(*)) AS weight FROM cls GROUP BY status""", "weight"))
def q_class_weights(spark, sf_dir):
    """Balanced class weights."""
    return G.class_weights(cls(spark, sf_dir), "status")


@register("class_weights_given", Q(["cls"], """
SELECT status, count(*) AS n_c, CASE status WHEN 'F' THEN 0.5 WHEN 'O' THEN 2.0 ELSE 1.0 END AS by_name, CASE status WHEN 'F' THEN 1.0 WHEN 'O' THEN 3.0 ELSE 7.0 END AS by_place
FROM cls GROUP BY status""", "by_name", "by_place"))
def q_class_weights_given(spark, sf_dir):
    """Weights given by class and as a list in sorted order."""
    c = cls(spark, sf_dir)
    named, listed = G.class_weights(c, "status", {"F": 0.5, "O": 2.0}), G.class_weights(c, "status", [1.0, 3.0, 7.0])
    return named.withColumnRenamed("weight", "by_name").join(listed.select("status", F.col("weight").alias("by_place")), "status")


@register("oversample", Q(["cls"], """
SELECT status, CAST((SELECT max(n) FROM (SELECT count(*) AS n FROM cls GROUP BY status)) AS BIGINT) AS rows FROM cls GROUP BY status"""))
def q_oversample(spark, sf_dir):
    """Class sizes after random oversampling to the majority size."""
    return G.oversample(cls(spark, sf_dir), "status", "row_id").groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


@register("undersample", Q(["cls"], """
SELECT status, CAST((SELECT min(n) FROM (SELECT count(*) AS n FROM cls GROUP BY status)) AS BIGINT) AS rows FROM cls GROUP BY status"""))
def q_undersample(spark, sf_dir):
    """Class sizes after random undersampling to the minority size."""
    return G.undersample(cls(spark, sf_dir), "status", "row_id").groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ L
def _over_event_batches(spark, sf_dir, run):
    """The events arrive in four batches of many files, each written in parallel; ``run(stream)`` drains what
    has arrived as one micro-batch and goes on from its state at the next. Returns its last result."""
    ev, path = table(spark, sf_dir, "events"), scratch_path(spark, "event-files")
    for k in range(4):
        ev.where(event_quarter() == k).write.mode("append").parquet(path)
        out = run(L.file_stream(spark, path, ev.schema, max_files_per_trigger=None))
    return out


def event_quarter():
    """0 to 3, the batch of an event: which thousand of every 4 000 event ids in a row (each batch spans the
    whole id range). Events without an id are in the last."""
    return F.coalesce(F.floor(F.pmod("event_id", F.lit(4000)) / 1000).cast("int"), F.lit(3))


@register("stream_score", rnd("SELECT event_id, 2.0 * value + 1.0 AS prediction FROM events", "prediction"))
def q_stream_score(spark, sf_dir):
    """L1: stateless scoring of the events file stream, drained with availableNow."""
    state, prediction = scratch_path(spark, "stream-score"), F.lit(2.0) * F.col("value") + F.lit(1.0)
    return _over_event_batches(spark, sf_dir, lambda s: L.run_to_files(L.stream_score(s, ["event_id"], prediction), state))


_QUARTER = "CAST(floor((event_id % 4000) / 1000) AS BIGINT)"


@register("stream_issue_totals", """
SELECT CASE WHEN value < 20 THEN 'low_value' WHEN value > 80 THEN 'high_value' END AS issue, count(*) AS count
FROM events WHERE value < 20 OR value > 80 GROUP BY 1""")
def q_stream_issues(spark, sf_dir):
    """L2: running counts of rows outside a validation range, over four micro-batches."""
    issue = F.when(F.col("value") < 20, F.lit("low_value")).when(F.col("value") > 80, F.lit("high_value"))
    state = scratch_path(spark, "stream-issues")
    return _over_event_batches(spark, sf_dir, lambda s: L.stream_issue_totals(s, issue, state))


@register("stream_chunk_stats", f"""
SELECT chunk, sum(rows) OVER w - rows AS row_start, sum(rows) OVER w AS row_end, rows, issues FROM (
  SELECT {_QUARTER} AS chunk, count(*) AS rows, count(*) FILTER (WHERE value < 20) AS issues FROM events GROUP BY 1)
WINDOW w AS (ORDER BY chunk ROWS UNBOUNDED PRECEDING)""")
def q_stream_chunks(spark, sf_dir):
    """Row range, rows and issue count per micro-batch."""
    state = scratch_path(spark, "stream-chunks")
    return _over_event_batches(spark, sf_dir, lambda s: L.stream_chunk_stats(s, F.col("value") < 20, state))
