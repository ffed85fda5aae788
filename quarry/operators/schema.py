"""Schema inference, projection, validation and coercion.

Schema-level work (field lists, type comparison) happens on ``StructType``
objects, which are metadata; data-level work (null counts, coercion failures)
is one aggregate or one projection over the table."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalars import FALSE_TOKENS, TRUE_TOKENS, canonicalize_missing

# Fixed value: reference cap on recorded coercion-failure samples.
COERCE_SAMPLE_CAP = 200


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType) and not isinstance(dt, T.BooleanType)


# ------------------------------------------------------------------ B4
def feature_types(schema: T.StructType, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """numeric (integral, fractional, decimal) vs categorical (everything else,
    booleans included), in feature order."""
    by_name = {f.name: f.dataType for f in schema.fields}
    num = [c for c in features if is_numeric_type(by_name[c])]
    cat = [c for c in features if not is_numeric_type(by_name[c])]
    return num, cat


# ------------------------------------------------------------------ B1
def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, dtype, rows, null_count, null_rate) from one aggregate, unpivoted."""
    cols = list(columns) if columns is not None else df.columns
    dtypes = dict(df.dtypes)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    stacked = agg.select("__rows", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"), F.lit(dtypes[c]).alias("dtype"),
                 F.col(f"__n{i}").alias("null_count")) for i, c in enumerate(cols)])).alias("s"))
    return stacked.select("s.column", "s.position", "s.dtype", F.col("__rows").alias("rows"), "s.null_count",
                          F.when(F.col("__rows") > 0, F.col("s.null_count") / F.col("__rows")).otherwise(0.0).alias("null_rate"))


def infer_schema(df: DataFrame) -> DataFrame:
    """B1: per column dtype, null_count, null_rate (NaN treated as missing)."""
    return null_counts(canonicalize_missing(df))


def schema_fields(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


# ------------------------------------------------------------------ B3
def select_features(df: DataFrame, target: str | None = None, ids: Sequence[str] = (), drops: Sequence[str] = ()) -> DataFrame:
    """Features = columns - target - ids - drops. Error if a named column is absent or nothing remains."""
    named = [c for c in [target, *ids, *drops] if c]
    absent = [c for c in named if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")
    feats = [c for c in df.columns if c not in set(named)]
    if not feats:
        raise ValueError("no feature columns remain")
    return df.select(*[F.col(f"`{c}`") for c in feats])


# ------------------------------------------------------------------ B5
def schema_diff(actual: T.StructType, expected: T.StructType, target: str | None = None) -> list[tuple[str, str, str | None, str | None]]:
    """Issues as (issue, column, expected, actual): missing_column, extra_column
    (the target never counts as extra) and dtype_mismatch."""
    exp = {f.name: f.dataType.simpleString() for f in expected.fields}
    act = {f.name: f.dataType.simpleString() for f in actual.fields}
    out: list[tuple[str, str, str | None, str | None]] = []
    out += [("missing_column", c, exp[c], None) for c in exp if c not in act]
    out += [("extra_column", c, None, act[c]) for c in act if c not in exp and c != target]
    out += [("dtype_mismatch", c, exp[c], act[c]) for c in exp if c in act and exp[c] != act[c]]
    return out


def schema_diff_df(spark, actual: T.StructType, expected: T.StructType, target: str | None = None) -> DataFrame:
    return spark.createDataFrame(schema_diff(actual, expected, target),
                                 "issue string, column string, expected string, actual string")


# ------------------------------------------------------------------ B6 / B7 / B8
def coerce_numeric(c) -> Column:
    """Text/number to double; unparsable -> NULL; NaN/Inf -> NULL."""
    x = F.col(c) if isinstance(c, str) else c
    v = (F.trim(x.cast("string"))).try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(v)


def coerce_datetime(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return (F.trim(x.cast("string"))).try_cast("timestamp_ntz") if not isinstance(c, Column) else (x).try_cast("timestamp_ntz")


def coerce_bool(c, dtype: T.DataType | None = None) -> Column:
    """bool passes; integers 1/0 -> true/false, other integers NULL; text trimmed and
    lower-cased in the true/false token sets; anything else NULL."""
    x = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, T.BooleanType):
        return x
    if isinstance(dtype, T.IntegralType):
        return F.when(x == 1, F.lit(True)).when(x == 0, F.lit(False)).otherwise(F.lit(None).cast("boolean"))
    t = F.lower(F.trim(x.cast("string")))
    return F.when(t.isin(TRUE_TOKENS), F.lit(True)).when(t.isin(FALSE_TOKENS), F.lit(False)).otherwise(F.lit(None).cast("boolean"))


_REASON = {"numeric": "numeric_coerce_failed", "datetime": "datetime_coerce_failed", "bool": "bool_coerce_failed"}


def _kind(dt: T.DataType) -> str | None:
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if is_numeric_type(dt):
        return "numeric"
    return None


def coerce_to_schema(df: DataFrame, expected: dict[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """Cast every expected column by its kind; returns the coerced frame and, per
    column, the failure predicate (input non-null and output null)."""
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    exprs, fails = [], {}
    for f in df.schema.fields:
        c = f.name
        want = expected.get(c)
        kind = _kind(T._parse_datatype_string(want)) if want else None
        if kind is None:
            exprs.append(F.col(f"`{c}`"))
            continue
        src = F.col(f"`{c}`")
        out = {"numeric": coerce_numeric(src), "datetime": (F.trim(src.cast("string"))).try_cast("timestamp_ntz"),
               "bool": coerce_bool(src, dtypes[c])}[kind]
        exprs.append(out.alias(c))
        fails[c] = src.isNotNull() & out.isNull()
    return df.select(*exprs), fails


# ------------------------------------------------------------------ B9
def coerce_failures(df: DataFrame, row_id: str, expected: dict[str, str], cap: int | None = None) -> DataFrame:
    """(row_id, column, reason) for every value that failed to coerce (optionally the
    first ``cap`` by row id)."""
    present = [c for c in expected if c in df.columns and _kind(T._parse_datatype_string(expected[c]))]
    if not present:
        return df.sparkSession.createDataFrame([], f"row_id string, column string, reason string")
    src = df.select(row_id, *[F.col(f"`{c}`") for c in present])
    coerced, fails = coerce_to_schema(src.drop(row_id), {c: expected[c] for c in present})
    del coerced
    items = F.array(*[F.when(fails[c], F.struct(F.lit(c).alias("column"),
                                                 F.lit(_REASON[_kind(T._parse_datatype_string(expected[c]))]).alias("reason")))
                      for c in present])
    out = src.select(F.col(row_id), F.explode(F.filter(items, lambda s: s.isNotNull())).alias("f")).select(
        F.col(row_id).alias("row_id"), "f.column", "f.reason")
    if cap is not None:
        out = out.orderBy("row_id", "column").limit(cap)
    return out


# ------------------------------------------------------------------ B10
def align_columns(df: DataFrame, expected: T.StructType, allow_missing: bool = True) -> DataFrame:
    """Keep the fitted feature columns in fitted order; absent ones become typed NULLs
    (or raise when ``allow_missing`` is False)."""
    missing = [f.name for f in expected.fields if f.name not in df.columns]
    if missing and not allow_missing:
        raise ValueError(f"Input is missing required columns: {missing}")
    return df.select(*[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in expected.fields])


# ------------------------------------------------------------------ B11
def validate_input(df: DataFrame, expected: T.StructType, row_id: str, mode: str = "warn",
                   target: str | None = None):
    """Modes: warn (issues are warnings), strict (issues are errors: raise before
    aligning), coerce (cast, then report failures). Returns
    (aligned frame, issues frame, warnings_count, errors_count, ok)."""
    spark = df.sparkSession
    diffs = schema_diff(df.schema, expected, target)
    exp_types = {f.name: f.dataType.simpleString() for f in expected.fields}
    work = df
    fail_df = None
    if mode == "coerce":
        fail_df = coerce_failures(df, row_id, exp_types)
        work, _ = coerce_to_schema(df, exp_types)
        diffs = [d for d in diffs if d[0] != "dtype_mismatch"]
    issues = spark.createDataFrame(diffs, "issue string, column string, expected string, actual string").select(
        "issue", "column", "expected", "actual", F.lit(None).cast("string").alias("row_id"))
    if fail_df is not None:
        issues = issues.unionByName(fail_df.select(F.col("reason").alias("issue"), "column",
                                                   F.lit(None).cast("string").alias("expected"),
                                                   F.lit(None).cast("string").alias("actual"),
                                                   F.col("row_id").cast("string")))
    n_issues = issues.count()
    if mode == "strict" and n_issues:
        raise ValueError(f"schema validation failed with {n_issues} issue(s)")
    aligned = align_columns(work, expected, allow_missing=True)
    warnings = n_issues if mode != "strict" else 0
    errors = n_issues if mode == "strict" else 0
    return aligned, issues, warnings, errors, errors == 0


# ------------------------------------------------------------------ B12
def merge_issues(issue_frames: Sequence[DataFrame]) -> DataFrame:
    """Fold issue sets: distinct schema issues, failure rows kept, counts per issue."""
    u = issue_frames[0]
    for f in issue_frames[1:]:
        u = u.unionByName(f)
    schema_part = u.where(F.col("row_id").isNull()).dropDuplicates(["issue", "column", "expected", "actual"])
    rows_part = u.where(F.col("row_id").isNotNull())
    return schema_part.unionByName(rows_part).groupBy("issue").agg(F.count(F.lit(1)).alias("count"))


# ------------------------------------------------------------------ B14
def rename_in_out(inp: DataFrame, out: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Side-by-side input/output, prefixed ``in.`` / ``out.``, full outer join on row id."""
    a = inp.select(F.col(row_id).alias("_k"), *[F.col(f"`{c}`").alias(f"in.{c}") for c in inp.columns if c != row_id])
    b = out.select(F.col(row_id).alias("_k"), *[F.col(f"`{c}`").alias(f"out.{c}") for c in out.columns if c != row_id])
    return a.join(b, "_k", "full_outer").withColumnRenamed("_k", row_id)
