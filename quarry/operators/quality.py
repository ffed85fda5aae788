"""Data quality and target leakage.

Scans the whole table by default (the reference looks at the first 50 000 rows).
Per-column distinct counts use a long form of (feature, 128-bit hash of the value): 16
bytes a value whatever its text, instead of many ``count(distinct)`` in one aggregate
(which plans an ``Expand`` per column). Two of n values share a hash with a probability
under n^2 / 2^129. Columns whose values mostly differ are dealt out by hash before they
are combined, since combining them in the map tasks only fills memory. A table's measures
are a few numbers per column and are taken once, however many rules use them.
Leak checks compute all features in one aggregate; mapping accuracy is three
nested group-bys over the long form."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.ranking import long_form
from quarry.functions.scalars import MISSING_TOKEN, canonicalize_missing
from quarry.operators.schema import feature_types, is_numeric_type, null_counts

# Reference default thresholds and name patterns.
THRESHOLDS = {
    "missing_rate_warn": 0.2, "missing_rate_fail": 0.5,
    "duplicates_rate_warn": 0.01, "duplicates_rate_fail": 0.05,
    "constant_columns_warn": 1, "constant_columns_fail": 5,
    "mixed_type_columns_warn": 1, "mixed_type_columns_fail": 5,
    "high_cardinality_ratio_warn": 0.8, "high_cardinality_ratio_fail": 1.01,
    "high_cardinality_min_unique": 20, "high_cardinality_count_fail": 9999,
    "id_like_ratio_warn": 0.98, "id_like_ratio_fail": 1.01, "id_like_min_unique": 20,
    "leak_near_match_warn": 0.98, "leak_correlation_warn": 0.98, "leak_mapping_accuracy_warn": 0.98,
}
LEAK_NAME_PATTERNS = ["target", "label", "outcome", "response"]
ID_NAME_PATTERNS = ["id", "uuid", "guid"]
MAX_MISSING_TOP = 10
MAX_CORR_TOP = 5
COMBINED = 100_000  # so many distinct values of a column are always combined in the map tasks


# ------------------------------------------------------------------ D1
def dq_missing(df: DataFrame, top: int = MAX_MISSING_TOP) -> DataFrame:
    """Top columns by missing rate (ties in column order), target included."""
    nc = null_counts(canonicalize_missing(df))
    return (nc.select("column", "position", "null_count", F.col("null_rate").alias("missing_rate"))
            .orderBy(F.col("missing_rate").desc(), F.col("position").asc()).limit(top))


def dq_missing_totals(df: DataFrame) -> DataFrame:
    nc = null_counts(canonicalize_missing(df))
    return nc.agg(F.sum("null_count").alias("missing_total"),
                  (F.sum("null_count") / (F.max("rows") * F.count(F.lit(1)))).alias("missing_rate_total"),
                  F.count_if(F.col("null_count") > 0).alias("missing_columns"))


# ------------------------------------------------------------------ D2
def dq_duplicates(df: DataFrame) -> DataFrame:
    """rows - distinct rows (NULL equals NULL), and the rate. Duplicates are
    combined map-side by the group-by, so one row repeated many times stays cheap.
    Rows of plain types are told apart by 128 bits of hashes (which columns are null is part of them)."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    if cols and not any(isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) for f in df.schema.fields):
        nulls = F.concat(*[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
        df = df.select(F.xxhash64(nulls, *cols).alias("a"), F.xxhash64(F.lit("check"), nulls, *cols).alias("b"))
        cols = [F.col("a"), F.col("b")]
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - 1).alias("duplicates")).select(
        "rows", "duplicates", F.when(F.col("rows") > 0, F.col("duplicates") / F.col("rows")).otherwise(0.0).alias("duplicates_rate"))


# ------------------------------------------------------------------ D3 / D4
COLUMN_COUNTS = "feature string, position int, dtype string, rows bigint, unique_count bigint, null_count bigint"


def column_counts(df: DataFrame) -> list[tuple]:
    """(column, position, dtype, rows, unique_count, null_count) per column; NULL counts as a value, texts of floating
    numbers as they are written (-0.0 is not 0.0). One pass counts rows and nulls and estimates which
    columns have mostly different values, a second one counts the distinct values of all columns exactly."""
    base = canonicalize_missing(df)
    fields = base.schema.fields
    if not fields:
        return []
    values = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        floating = isinstance(f.dataType, (T.FloatType, T.DoubleType))
        values.append((c, [F.when(c == 0, c.cast("string")), c] if floating else [c.cast("string")]))
    one = base.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"k{i}") for i, (c, _) in enumerate(values)],
                   *[F.approx_count_distinct(F.xxhash64(*v)).alias(f"d{i}") for i, (_, v) in enumerate(values)]).first()
    if not one["n"]:
        return []

    def keys(places: list[int]) -> DataFrame:
        each = F.array(*[F.when(values[i][0].isNotNull(), F.struct(F.lit(i).alias("f"), F.xxhash64(*values[i][1]).alias("a"),
                                                                    F.xxhash64(F.lit("check"), *values[i][1]).alias("b"))) for i in places])
        return base.select(F.explode(each).alias("k")).where(F.col("k").isNotNull()).select("k.*")

    many = [i for i in range(len(fields)) if one[f"d{i}"] > max(COMBINED, one["n"] // 2)]
    few = [i for i in range(len(fields)) if i not in many]
    distinct = {}
    for places in (few, many):
        if places:
            k = keys(places)
            k = k.repartition("f", "a", "b") if places is many else k
            distinct |= {r["f"]: r["n"] for r in k.distinct().groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per column
    return [(f.name, i, f.dataType.simpleString(), one["n"], distinct.get(i, 0) + (one[f"k{i}"] < one["n"]), one["n"] - one[f"k{i}"])
            for i, f in enumerate(fields)]


def dq_cardinality(df: DataFrame, counts: list[tuple] | None = None) -> DataFrame:
    """Per column: unique_count (NULL counts as a value), unique_ratio, missing_rate. ``counts``: of
    :func:`column_counts`, if they are known."""
    per = df.sparkSession.createDataFrame(column_counts(df) if counts is None else counts, COLUMN_COUNTS)
    return per.select(
        F.col("feature").alias("column"), "position", "dtype", "unique_count",
        F.when(F.col("rows") > 0, F.col("unique_count") / F.col("rows")).otherwise(0.0).alias("unique_ratio"),
        F.when(F.col("rows") > 0, F.col("null_count") / F.col("rows")).otherwise(0.0).alias("missing_rate"))


def dq_constant(df: DataFrame) -> DataFrame:
    return dq_cardinality(df).where(F.col("unique_count") <= 1).select("column")


# ------------------------------------------------------------------ D5
def dq_id_like(df: DataFrame, target: str | None = None, ids: Sequence[str] = (),
               min_unique: int = 20, ratio: float = 0.98, counts: list[tuple] | None = None) -> DataFrame:
    card = dq_cardinality(df, counts)
    return card.where((F.col("column") != F.lit(target or "")) & (F.col("unique_count") >= min_unique)
                      & (F.col("unique_ratio") >= ratio)).select(
        "column", "unique_count", "unique_ratio", "missing_rate", F.col("column").isin(list(ids) or [""]).alias("declared_id"))


# ------------------------------------------------------------------ D6
def dq_high_cardinality(df: DataFrame, target: str | None = None, ids: Sequence[str] = (),
                        min_unique: int = 20, ratio: float = 0.8, counts: list[tuple] | None = None) -> DataFrame:
    """unique >= min and ratio >= r and (non-numeric or integer/boolean)."""
    eligible = [f.name for f in df.schema.fields
                if not is_numeric_type(f.dataType) or isinstance(f.dataType, (T.IntegralType, T.BooleanType))]
    card = dq_cardinality(df, counts)
    return card.where((F.col("column") != F.lit(target or "")) & F.col("column").isin(eligible or [""])
                      & (F.col("unique_count") >= min_unique) & (F.col("unique_ratio") >= ratio)).select(
        "column", "unique_count", "unique_ratio", "missing_rate", F.col("column").isin(list(ids) or [""]).alias("declared_id"))


# ------------------------------------------------------------------ D7
def value_bucket(c) -> F.Column:
    """Type bucket of a text value: bool, number, datetime, else string. A text with a sign that no number has
    is not parsed as one: a failed parse costs far more than the look."""
    x = F.trim(F.col(c) if isinstance(c, str) else c)
    low = F.lower(x)
    return (F.when(low.isin("true", "false"), F.lit("bool"))
            .when(~x.rlike(r"[!-*,/:-@\[-`{-~]") & x.try_cast("double").isNotNull(), F.lit("number"))
            .when((x).try_cast("timestamp_ntz").isNotNull(), F.lit("datetime"))
            .otherwise(F.lit("string")))


def dq_mixed_types(df: DataFrame) -> DataFrame:
    """String columns whose non-null values fall into more than one type bucket:
    (column, bucket, count) for those columns (the full column is scanned)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, bucket string, count bigint")
    lf = long_form(df, [], cols, "string").where(F.col("value").isNotNull())
    b = lf.groupBy(F.col("feature").alias("column"), value_bucket("value").alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    multi = b.groupBy("column").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
    return b.join(multi, "column", "left_semi")


# ------------------------------------------------------------------ D8
def dq_name_suspects(df: DataFrame, target: str | None = None, leak_patterns: Sequence[str] | None = None,
                     id_patterns: Sequence[str] | None = None, ids: Sequence[str] = ()) -> DataFrame:
    """Column names containing a leak or id pattern (lower-cased substring):
    (column, kind, patterns, declared_id). Schema-level: one row per column name."""
    lp = [*LEAK_NAME_PATTERNS, *[p for p in leak_patterns or () if p not in LEAK_NAME_PATTERNS]]  # user patterns extend the defaults
    if target and target.lower() not in lp:
        lp.append(target.lower())
    ip = [*ID_NAME_PATTERNS, *[p for p in id_patterns or () if p not in ID_NAME_PATTERNS]]
    rows = []
    for c in df.columns:
        if target and c == target:
            continue
        low = c.lower()
        m = [p for p in lp if p and p.lower() in low]
        if m:
            rows.append((c, "leak_suspect", ",".join(m), c in ids))
        m = [p for p in ip if p and p.lower() in low]
        if m:
            rows.append((c, "id_suspect", ",".join(m), c in ids))
    return df.sparkSession.createDataFrame(rows, "column string, kind string, patterns string, declared_id boolean")


# ------------------------------------------------------------------ D9 / D10
def dq_leak_match(df: DataFrame, target: str, ids: Sequence[str] = (), near: float = 0.98) -> DataFrame:
    """Per feature: exact (same type, equal everywhere incl. NULL) and match_rate
    (share of rows equal, NULL = NULL). Exact -> error; else rate >= near -> warning."""
    base = canonicalize_missing(df)
    tdt = base.schema[target].dataType
    feats = [f for f in base.schema.fields if f.name != target and f.name not in ids]
    aggs = []
    for i, f in enumerate(feats):
        comparable = (f.dataType == tdt) or (is_numeric_type(f.dataType) and is_numeric_type(tdt)) or (
            isinstance(f.dataType, T.StringType) and isinstance(tdt, T.StringType))
        if comparable:
            a, b = F.col(f"`{f.name}`"), F.col(f"`{target}`")
            if f.dataType != tdt:
                a, b = a.cast("double"), b.cast("double")
            eq = a.eqNullSafe(b)
            aggs.append(F.avg(eq.cast("double")).alias(f"r{i}"))
            aggs.append((F.bool_and(eq) if f.dataType == tdt else F.lit(False)).alias(f"e{i}"))
        else:
            aggs.append(F.lit(0.0).alias(f"r{i}"))
            aggs.append(F.lit(False).alias(f"e{i}"))
    if not feats:
        return base.sparkSession.createDataFrame([], "column string, exact boolean, match_rate double, reason string, severity string")
    one = base.agg(*aggs)
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(f.name).alias("column"), F.coalesce(F.col(f"e{i}"), F.lit(True)).alias("exact"),
                                                   F.coalesce(F.col(f"r{i}"), F.lit(0.0)).alias("match_rate"))
                                          for i, f in enumerate(feats)])).alias("s")).select("s.*")
    return rows.where(F.col("exact") | (F.col("match_rate") >= near)).select(
        "column", "exact", "match_rate",
        F.when(F.col("exact"), F.lit("exact_match")).otherwise(F.lit("near_match")).alias("reason"),
        F.when(F.col("exact"), F.lit("error")).otherwise(F.lit("warning")).alias("severity"))


# ------------------------------------------------------------------ D11
def dq_leak_correlation(df: DataFrame, target: str, ids: Sequence[str] = (), threshold: float = 0.98,
                        top: int | None = MAX_CORR_TOP) -> DataFrame:
    """Pearson correlation of each numeric feature with the target on pairwise-complete
    rows (n >= 2); top n by |corr| (all if ``top`` is None); flagged when |corr| >= threshold."""
    base = canonicalize_missing(df)
    num, _ = feature_types(base.schema, [c for c in base.columns if c != target and c not in ids])
    if not num:
        return base.sparkSession.createDataFrame([], "column string, corr double, flagged boolean")
    t = F.col(f"`{target}`").cast("double")
    aggs = []
    for i, c in enumerate(num):
        x = F.col(f"`{c}`").cast("double")
        both = x.isNotNull() & t.isNotNull()
        xm, tm = F.when(both, x), F.when(both, t)
        aggs += [F.try_divide(F.covar_pop(xm, tm), F.stddev_pop(xm) * F.stddev_pop(tm)).alias(f"c{i}"),
                 F.count_if(both).alias(f"n{i}")]
    one = base.agg(*aggs)
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("corr"),
                                                   F.col(f"n{i}").alias("n")) for i, c in enumerate(num)])).alias("s")).select("s.*")
    rows = rows.where((F.col("n") >= 2) & F.col("corr").isNotNull() & ~F.isnan("corr"))
    ranked = rows.orderBy(F.abs(F.col("corr")).desc(), F.col("column").asc())
    ranked = ranked if top is None else ranked.limit(top)
    return ranked.select("column", "corr", (F.abs(F.col("corr")) >= threshold).alias("flagged"))


# ------------------------------------------------------------------ D12
def dq_leak_mapping(df: DataFrame, target: str, ids: Sequence[str] = (), threshold: float = 0.98) -> DataFrame:
    """Per feature: accuracy of predicting the target from the feature value alone
    (sum over values of the majority target count / rows), deterministic flag, suspect flag."""
    feats = [c for c in df.columns if c != target and c not in ids]
    base = canonicalize_missing(df).select(
        F.coalesce(F.col(f"`{target}`").cast("string"), F.lit(MISSING_TOKEN)).alias("_t"),
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TOKEN)).alias(c) for c in feats])
    lf = base.unpivot(["_t"], feats, "feature", "value")
    vt = lf.groupBy("feature", "value", "_t").agg(F.count(F.lit(1)).alias("_n"))
    v = vt.groupBy("feature", "value").agg(F.max("_n").alias("_mx"), F.count(F.lit(1)).alias("_nt"), F.sum("_n").alias("_rows"))
    per = v.groupBy("feature").agg((F.sum("_mx") / F.sum("_rows")).alias("accuracy"),
                                   (F.max("_nt") <= 1).alias("deterministic"),
                                   F.count(F.lit(1)).alias("unique_values"))
    return per.select(F.col("feature").alias("column"), "accuracy", "deterministic", "unique_values",
                      (F.col("deterministic") | (F.col("accuracy") >= threshold)).alias("suspect"))


# ------------------------------------------------------------------ D13
def _measures(df: DataFrame, target: str | None, task: str, ids: Sequence[str], th: dict) -> dict:
    """What the rules and the summary are made of, each taken once; a few numbers per column."""
    counts = column_counts(df)
    du = dq_duplicates(df).first()
    hc = dq_high_cardinality(df, target, ids, th["high_cardinality_min_unique"], th["high_cardinality_ratio_warn"], counts)
    il = dq_id_like(df, target, ids, th["id_like_min_unique"], th["id_like_ratio_warn"], counts)
    return {
        "counts": counts, "duplicates": du["duplicates"], "duplicates_rate": du["duplicates_rate"],
        "mixed": dq_mixed_types(df).select("column").distinct().count(),
        "high_cardinality": [r["unique_ratio"] for r in hc.collect()], "id_like": [r["unique_ratio"] for r in il.collect()],
        "names": dq_name_suspects(df, target, ids=ids).count(),
        "leaks": [r["severity"] for r in leak_suspects(df, target, task, ids, th).select("severity").collect()] if target else [],
    }


def _rules(m: dict, target: str | None, th: dict) -> list[tuple]:
    """(type, severity, count) of the rules that do not pass."""
    counts = m["counts"]
    cells, nulls = sum(c[3] for c in counts), sum(c[5] for c in counts)
    missing, rate, dup = nulls / cells if cells else None, m["duplicates_rate"], m["duplicates"]

    def graded(x, name):
        return None if x is None else "fail" if x >= th[f"{name}_fail"] else "warn" if x >= th[f"{name}_warn"] else None

    constant = sum(c[4] <= 1 for c in counts)
    rules = [("missing_rate", graded(missing, "missing_rate"), 1), ("duplicates", graded(rate, "duplicates_rate"), dup if dup and dup > 0 else 1)]
    for name, n in (("constant_columns", constant), ("mixed_type_columns", m["mixed"])):
        rules.append((name, None if n == 0 else "fail" if n >= th[f"{name}_fail"] else "warn", n))
    hc, il = m["high_cardinality"], m["id_like"]
    worst = any(r >= th["high_cardinality_ratio_fail"] for r in hc) or len(hc) >= th["high_cardinality_count_fail"]
    rules.append(("high_cardinality", None if not hc else "fail" if worst else "warn", len(hc)))
    rules.append(("id_like", None if not il else "fail" if any(r >= th["id_like_ratio_fail"] for r in il) else "warn", len(il)))
    rules.append(("name_suspect", "warn" if m["names"] else None, m["names"]))
    if target:
        errors = sum(x == "error" for x in m["leaks"])
        rules.append(("leak", "fail" if errors else None, errors))
        rules.append(("leak", "warn" if len(m["leaks"]) > errors else None, len(m["leaks"]) - errors))
    return [r for r in rules if r[1] is not None]


def dq_evaluate(df: DataFrame, target: str | None = None, task: str = "regression", ids: Sequence[str] = (),
                thresholds: dict | None = None) -> DataFrame:
    """Rule table (type, severity, count) plus status (fail > warn > pass) and issue_count."""
    th = dict(THRESHOLDS, **(thresholds or {}))
    return df.sparkSession.createDataFrame(_rules(_measures(df, target, task, ids, th), target, th), "type string, severity string, count bigint")


def leak_suspects(df: DataFrame, target: str, task: str = "regression", ids: Sequence[str] = (),
                  thresholds: dict | None = None) -> DataFrame:
    """(column, reason, severity, score) from D9-D12."""
    th = dict(THRESHOLDS, **(thresholds or {}))
    m = dq_leak_match(df, target, ids, th["leak_near_match_warn"]).select(
        "column", "reason", "severity", F.when(F.col("exact"), F.lit(1.0)).otherwise(F.col("match_rate")).alias("score"))
    if task == "regression":
        x = dq_leak_correlation(df, target, ids, th["leak_correlation_warn"], top=None).where("flagged").select(
            "column", F.lit("high_correlation").alias("reason"), F.lit("warning").alias("severity"), F.col("corr").alias("score"))
    else:
        x = dq_leak_mapping(df, target, ids, th["leak_mapping_accuracy_warn"]).where("suspect").select(
            "column", F.when(F.col("deterministic"), "deterministic_mapping").otherwise("high_accuracy_mapping").alias("reason"),
            F.lit("warning").alias("severity"), F.col("accuracy").alias("score"))
    # As in the reference, an exact match skips only the near-match test; the
    # correlation / mapping tests still run on it under their own reason.
    return m.unionByName(x)


def dq_status(rules: DataFrame) -> DataFrame:
    """status = fail > warn > pass; issue_count = sum of counts."""
    return rules.agg(
        F.coalesce(F.max(F.when(F.col("severity") == "fail", 2).when(F.col("severity") == "warn", 1)), F.lit(0)).alias("_s"),
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("issue_count")).select(
        F.when(F.col("_s") == 2, "fail").when(F.col("_s") == 1, "warn").otherwise("pass").alias("status"), "issue_count")


# ------------------------------------------------------------------ D14
def dq_gate(df: DataFrame, mode: str = "warn", **kw) -> tuple[str, list[str]]:
    """Run the gate: returns (status, fail reasons); raises only when mode=fail and status=fail."""
    m = {"warn": "warn", "warning": "warn", "fail": "fail", "error": "fail", "strict": "fail", "off": "off",
         "none": "off", "disabled": "off", "disable": "off", "no": "off"}.get(str(mode).lower().strip(), "warn")
    if m == "off":
        return "skipped", []
    rules = dq_evaluate(df, **kw)
    rows = rules.collect()  # rule table: one row per rule type (<= 10 rows)
    status = "fail" if any(r.severity == "fail" for r in rows) else ("warn" if rows else "pass")
    reasons = [r.type if (r["count"] or 0) <= 1 else f"{r.type}({r['count']})" for r in rows if r.severity == "fail"]
    if m == "fail" and status == "fail":
        raise RuntimeError(f"data quality gate failed: {', '.join(reasons)}")
    return status, reasons


# ------------------------------------------------------------------ D15
def dq_summary(df: DataFrame, target: str | None = None, task: str = "regression", ids: Sequence[str] = ()) -> DataFrame:
    """1-row roll-up: rows, columns, missing_rate_max, duplicates, counts per finding, leak_error, status."""
    m = _measures(df, target, task, ids, THRESHOLDS)
    spark, counts = df.sparkSession, m["counts"]
    n = counts[0][3] if counts else 0
    st = dq_status(spark.createDataFrame(_rules(m, target, THRESHOLDS), "type string, severity string, count bigint")).first()
    row = [n, len(df.columns), sum(c[5] > 0 for c in counts), max((c[5] / c[3] for c in counts), default=0.0), m["duplicates"],
           len(m["high_cardinality"]), len(m["id_like"]), m["mixed"], m["names"]]
    names = ["rows bigint", "columns bigint", "missing_columns bigint", "missing_rate_max double", "duplicates_count bigint",
             "high_cardinality_count bigint", "id_like_count bigint", "mixed_type_count bigint", "name_suspect_count bigint"]
    if target:
        row += [len(m["leaks"]), "error" in m["leaks"]]
        names += ["leak_suspect_count bigint", "leak_error boolean"]
    return spark.createDataFrame([(*row, st["status"], st["issue_count"])], ", ".join([*names, "quality_status string", "quality_issue_count bigint"]))
