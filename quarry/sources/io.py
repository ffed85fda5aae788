"""Scans, sinks and dataset identity.

Scans are plain ``spark.read`` calls so Catalyst prunes columns and pushes
filters into the Parquet reader. Round trips write under the session's shared
checkpoint folder (``spark.checkpoint.dir``), never a machine-local path."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

# Fixed value: file suffixes recognised as tabular inputs.
TABULAR_SUFFIXES = (".csv", ".parquet", ".pq")


def shared_scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quarry-io/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ A1 / A2 / A3 / A4
def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def scan_directory(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet and CSV files below ``path`` (recursive), united by column name (a column
    that one format lacks is null there). Unreadable files raise; so does a folder with neither."""
    def files(glob: str) -> list[str]:
        return (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).format("binaryFile").load(path)
                .select("path").distinct().toPandas()["path"].tolist())  # names only

    parts = []
    if parquet := files("*.{parquet,pq}"):
        parts.append(spark.read.parquet(*parquet))
    if csv := files("*.csv"):
        parts.append(spark.read.option("header", True).option("inferSchema", True).csv(csv))
    if not parts:
        raise FileNotFoundError(f"no Parquet or CSV file below {path}")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)


def scan_json_records(spark: SparkSession, path: str, schema=None, multi_line: bool = False) -> DataFrame:
    """JSON records (one per line), or with ``multi_line`` a document holding an object,
    a list of objects, or a wrapper object with ``records`` / ``inputs``."""
    r = spark.read.option("multiLine", multi_line)
    df = r.schema(schema).json(path) if schema is not None else r.json(path)
    for key in ("records", "inputs"):
        if key in df.columns and len(df.columns) == 1:
            return df.select(F.inline(key))
    return df


# ------------------------------------------------------------------ A5 / A19
def scan_limit(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(n)


def preview_head(df: DataFrame, row_id: str, n: int = 5, max_cols: int = 20) -> DataFrame:
    """First n rows by row id, at most ``max_cols`` columns; date/time values rendered
    as text (a display preview)."""
    from pyspark.sql import types as T
    cols = df.columns[:max_cols]
    out = []
    for f in df.schema.fields:
        if f.name not in cols:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.orderBy(row_id).limit(n).select(*out)


# ------------------------------------------------------------------ A7 / A8
def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-insensitive content id: row count and the exact sum of 60-bit row hashes (md5 of the
    row's values as text, so that any engine with md5 can check it)."""
    row = F.concat_ws("\x1f", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x1e")) for c in df.columns])
    h = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(h).cast("string").alias("content_hash")).select(
        "rows", "content_hash", F.sha2(F.concat_ws(":", F.col("rows").cast("string"), "content_hash"), 256).alias("fingerprint"))


def processed_dataset_id(raw_fp: DataFrame, split_fp: DataFrame, recipe_hash: str) -> DataFrame:
    a, b = raw_fp.select("fingerprint").scalar(), split_fp.select("fingerprint").scalar()
    return raw_fp.sparkSession.range(1).select(
        F.sha2(F.to_json(F.struct(a.alias("raw"), F.lit(recipe_hash).alias("recipe"), b.alias("split"))), 256).alias("processed_dataset_id"))


# ------------------------------------------------------------------ A9: see quarry.functions.scalars.canonicalize_missing
# ------------------------------------------------------------------ A10 / A13 / A14 / A16 / A17
def sink(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = (),
         forbid_parquet_append: bool = False) -> str:
    if fmt == "parquet" and mode == "append" and forbid_parquet_append:
        raise ValueError("appending to Parquet output is disabled")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def proba_columns(df: DataFrame, proba: str, labels: Sequence[str], prefix: str = "proba__") -> DataFrame:
    """Probability array to one column per class label."""
    return df.select(*[c for c in df.columns if c != proba],
                     *[F.col(proba)[i].alias(f"{prefix}{l}") for i, l in enumerate(labels)])


def load_preds(df: DataFrame, labels: Sequence[str], prefix: str = "proba__") -> DataFrame:
    """Require y_true, rebuild the probability array in label order, default y_pred = argmax."""
    if "y_true" not in df.columns:
        raise ValueError("prediction table needs y_true")
    cols = [f"{prefix}{l}" for l in labels]
    if len(cols) < 2 or any(c not in df.columns for c in cols):
        raise ValueError("classification predictions need one probability column per class")
    arr = F.array(*[F.col(c) for c in cols])
    out = df.withColumn("proba", arr)
    if "y_pred" not in df.columns:
        out = out.withColumn("y_pred", F.array_position(arr, F.array_max(arr)) - 1)
    return out


# ------------------------------------------------------------------ A12
def join_xy(x: DataFrame, y: DataFrame, row_id: str = "row_id") -> DataFrame:
    return x.join(y, row_id)


# ------------------------------------------------------------------ A18
def alert_rows(report: DataFrame, kind: str, name_col: str = "feature", status_col: str = "status", value_col: str | None = None,
               at: str | None = None) -> DataFrame:
    """One alert row per warn/fail finding; severity error when it failed. ``timestamp`` is
    ``at`` or the time of the query (UTC, to the second); ``message`` names the finding, and
    its value to 6 places if ``value_col`` is given."""
    bad = report.where(F.col(status_col).isin("warn", "fail"))
    now = F.lit(at) if at is not None else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    value = F.lit("") if value_col is None else F.concat(F.lit(f", {value_col}="), F.round(F.col(value_col), 6).cast("decimal(18,6)").cast("string"))
    return bad.select(now.alias("timestamp"), F.lit(kind).alias("kind"),
                      F.concat(F.col(name_col), F.lit(" is "), F.col(status_col), value).alias("message"),
                      F.when(F.col(status_col) == "fail", F.lit("error")).otherwise(F.lit("warning")).alias("severity"),
                      F.concat(F.lit(f"{kind} "), F.col(status_col), F.lit(": "), F.col(name_col)).alias("title"),
                      F.col(name_col).alias("context"))


# ------------------------------------------------------------------ A6
def chunk_ranges(df: DataFrame, row_id: str, chunk_size: int) -> DataFrame:
    """Chunk index and row range per chunk of ``chunk_size`` rows in row-id order:
    (chunk, row_start, row_end, rows). Positions come from the distributed rank."""
    from quarry.functions.ranking import global_rank
    r = global_rank(df.select(row_id), [row_id], "_pos")
    c = F.floor(F.col("_pos") / F.lit(chunk_size)).cast("bigint")
    return r.groupBy(c.alias("chunk")).agg(F.min("_pos").alias("row_start"), (F.max("_pos") + 1).alias("row_end"),
                                            F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------------ A11
def save_recipe(spark: SparkSession, params: dict, path: str) -> str:
    """Persist fitted scaling constants as a small Parquet lookup (one row per feature)."""
    rows = [(c, float(m), float(s)) for c, (m, s) in params.items()]
    spark.createDataFrame(rows, "feature string, center double, scale double").write.mode("overwrite").parquet(path)
    return path


def rebuild_processed(raw: DataFrame, recipe_path: str, prefix: str = "num__") -> DataFrame:
    """Re-apply a saved recipe to raw rows (the recipe has one row per feature)."""
    rec = raw.sparkSession.read.parquet(recipe_path).collect()
    return raw.withColumns({f"{prefix}{r.feature}": (F.col(r.feature) - F.lit(r.center)) / F.lit(r.scale) for r in rec})
