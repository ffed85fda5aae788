"""Structured Streaming twins of the chunked batch scorer.

A file source over Parquet drops is the chunk iterator; each micro-batch is a
chunk. Every operator keeps its checkpoint, state and output under one ``state``
folder that the caller names. Starting it again with the same folder goes on
after the last finished batch, in the same or in another driver: nothing lives
in Python variables, and what a retried batch writes replaces its own version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _drain(stream: DataFrame, fn, state: str) -> None:
    """Run every available input through ``fn(batch, batch_id)``."""
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", f"{state}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def _versions(spark: SparkSession, folder: str, schema) -> DataFrame:
    """All versions written so far, with their batch id ``v`` (empty before the first)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _forget(spark: SparkSession, folder: str, before: int) -> None:
    """Delete the versions under ``folder`` whose batch id is below ``before``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(p) if fs.exists(p) else ():
        name = f.getPath().getName()
        if name.startswith("v=") and int(name[2:]) < before:
            fs.delete(f.getPath(), True)


def file_stream(spark: SparkSession, folder: str, schema, glob: str = "*.parquet", max_files_per_trigger: int | None = 1) -> DataFrame:
    """Parquet files arriving in ``folder`` (matching ``glob``), one file per micro-batch by default; with
    None a micro-batch has all files that have arrived."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return (reader if max_files_per_trigger is None else reader.option("maxFilesPerTrigger", max_files_per_trigger)).parquet(folder)


def run_to_files(stream: DataFrame, state: str) -> DataFrame:
    """Drain every available input (availableNow) into Parquet under ``state`` and return all rows written so far."""
    spark, out = stream.sparkSession, f"{state}/out"
    q = (stream.writeStream.format("parquet").option("path", out).outputMode("append")
         .option("checkpointLocation", f"{state}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


# ------------------------------------------------------------------ L1
def stream_score(stream: DataFrame, keep: list[str], prediction: Column) -> DataFrame:
    return stream.select(*keep, prediction.alias("prediction"))


# ------------------------------------------------------------------ L2
def stream_issue_totals(stream: DataFrame, issue: Column, state: str) -> DataFrame:
    """Counts per issue over all batches so far (a row per issue). A batch adds its counts to the newest version
    before its own and writes them under its batch id; the two newest versions are kept."""
    spark, out = stream.sparkSession, f"{state}/out"
    kept = "issue string, count bigint, v bigint"

    def per_batch(batch: DataFrame, batch_id: int):
        counts = batch.select(issue.alias("issue"), F.lit(1).cast("bigint").alias("count")).where(F.col("issue").isNotNull())
        past = _versions(spark, out, kept).where(F.col("v") < batch_id)
        past = past.where(F.col("v") == past.agg(F.max("v")).scalar()).select("issue", "count")
        now = counts.unionByName(past).groupBy("issue").agg(F.sum("count").alias("count"))
        now.write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        _forget(spark, out, batch_id - 1)

    _drain(stream, per_batch, state)
    every = _versions(spark, out, kept)
    return every.where(F.col("v") == every.agg(F.max("v")).scalar()).select("issue", "count")


# ------------------------------------------------------------------ L6
def stream_chunk_stats(stream: DataFrame, issue: Column, state: str) -> DataFrame:
    """Per micro-batch: chunk index, row range [row_start, row_end), rows and issue count."""
    spark, out = stream.sparkSession, f"{state}/out"

    def per_batch(batch: DataFrame, batch_id: int):
        stats = batch.agg(F.count(F.lit(1)).alias("rows"), F.count_if(issue).alias("issues")).select(
            F.lit(batch_id).cast("bigint").alias("chunk"), "rows", "issues")
        stats.write.mode("overwrite").parquet(f"{out}/v={batch_id}")

    _drain(stream, per_batch, state)
    chunks = spark.read.schema("chunk bigint, rows bigint, issues bigint").parquet(out)
    w = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row per batch
    end = F.sum("rows").over(w)
    return chunks.select("chunk", (end - F.col("rows")).alias("row_start"), end.alias("row_end"), "rows", "issues")


# ------------------------------------------------------------------ L3
def stream_sample(stream: DataFrame, key: str, n: int, state: str, seed: int = 0) -> DataFrame:
    """Uniform bottom-n sample by md5(seed:key) kept across micro-batches and restarts. The
    state is at most n rows per version; a batch builds on the newest version before its own,
    and the result does not depend on chunk order (unlike re-sampling per chunk)."""
    from pyspark.sql import types as T

    from quarry.functions.hashing import hash_unit
    spark, out = stream.sparkSession, f"{state}/out"
    schema = T.StructType([*stream.schema.fields, T.StructField("_h", T.LongType())])
    kept = T.StructType([*schema.fields, T.StructField("v", T.LongType())])

    def newest(before: int | None = None) -> DataFrame:
        past = _versions(spark, out, kept)
        past = past if before is None else past.where(F.col("v") < before)
        return past.where(F.col("v") == past.agg(F.max("v")).scalar()).select(*schema.names)

    def per_batch(batch: DataFrame, batch_id: int):
        cur = batch.withColumn("_h", hash_unit(seed, key)).unionByName(newest(batch_id))
        cur.orderBy("_h", key).limit(n).write.mode("overwrite").parquet(f"{out}/v={batch_id}")
        _forget(spark, out, batch_id - 1)

    _drain(stream, per_batch, state)
    return newest().drop("_h")


# ------------------------------------------------------------------ L4
def stream_drift(stream: DataFrame, train: DataFrame, features: list[str], state: str, edges: DataFrame | None = None) -> DataFrame:
    """Histogram counts of each micro-batch against the train edges (``edges`` if they are fitted already)
    are kept per batch id; after the last batch they are summed and compared with the train counts."""
    from quarry.operators import drift as K
    spark, out = stream.sparkSession, f"{state}/out"
    edges = K.hist_edges(train, features) if edges is None else edges

    def per_batch(batch: DataFrame, batch_id: int):
        K.hist_counts(batch, features, edges).write.mode("overwrite").parquet(f"{out}/v={batch_id}")

    _drain(stream, per_batch, state)
    new_counts = spark.read.schema("feature string, bin bigint, count bigint").parquet(out).groupBy("feature", "bin").agg(F.sum("count").alias("a"))
    tc = K.hist_counts(train, features, edges).withColumnRenamed("count", "e")
    buckets = tc.join(new_counts, ["feature", "bin"], "left").fillna(0, ["a"])
    stats = K._psi_ks(buckets.select("feature", "bin", F.col("e").cast("double").alias("e"), F.col("a").cast("double").alias("a")), True)
    return stats.select("feature", "psi", "ks", K._status(F.col("psi"), K.PSI_WARN, K.PSI_FAIL, False).alias("status"))


# ------------------------------------------------------------------ L5
def stream_quality_gate(stream: DataFrame, state: str, target: str | None = None) -> DataFrame:
    """Quality rules on the first micro-batch only (reference parity)."""
    from quarry.operators.quality import dq_evaluate
    out = f"{state}/out"

    def per_batch(batch: DataFrame, batch_id: int):
        if batch_id == 0:
            dq_evaluate(batch, target).write.mode("overwrite").parquet(out)

    _drain(stream, per_batch, state)
    return stream.sparkSession.read.schema("type string, severity string, count bigint").parquet(out)


# ------------------------------------------------------------------ I8 / A13 / A16
class GateFailed(RuntimeError):
    """The first batch did not pass the gate, or a batch has issues in strict mode."""


MANIFEST = "chunk bigint, row_start bigint, row_end bigint, rows_in bigint, rows_out bigint, issues bigint"
ERRORS = "chunk bigint, row_start bigint, row_end bigint, reason string, rows bigint"


def finished_batches(spark: SparkSession, state: str) -> DataFrame:
    """One row per finished batch: chunk, row_start, row_end, rows_in, rows_out, issues."""
    return _versions(spark, f"{state}/manifest", MANIFEST)


def error_log(spark: SparkSession, state: str) -> DataFrame:
    """JSON lines of all batches: chunk, its row range, the reason and how many of its rows have it."""
    path = f"{state}/errors"
    return spark.read.schema(ERRORS).json(path) if _exists(spark, path) else spark.createDataFrame([], ERRORS)


def score_exactly_once(stream: DataFrame, score, state: str, checks: dict[str, Column] | None = None, mode: str = "warn", gate=None) -> DataFrame:
    """Score a stream batch by batch and append the predictions under ``state``, each row once.

    ``score(batch)`` gives the predictions of a batch. ``checks`` names conditions under which a row has an issue; their
    counts go to the error log with the batch's row range. ``mode``: warn scores all rows, drop scores those without
    an issue, strict stops at the first batch with one. ``gate(batch)`` gives (status, reasons) of the first batch;
    status fail stops before anything is scored.

    A batch is finished when its manifest entry is written, after its predictions: what an interrupted batch left
    is overwritten when it runs again, and a batch that was finished but not yet committed by the stream is
    passed over. Predictions of batches without an entry are not read. Returns all predictions so far, with
    the batch id as ``chunk``."""
    if mode not in ("warn", "drop", "strict"):
        raise ValueError(f"unknown mode '{mode}'")
    spark, checks = stream.sparkSession, dict(checks or {})

    def per_batch(batch: DataFrame, batch_id: int):
        if _exists(spark, f"{state}/manifest/v={batch_id}/_SUCCESS"):
            return
        if batch_id == 0 and gate is not None:
            status, reasons = gate(batch)
            if status == "fail":
                raise GateFailed(f"the first batch does not pass: {', '.join(reasons)}")
        bad = [F.coalesce(c, F.lit(False)) for c in checks.values()]
        any_bad = F.lit(False)
        for c in bad:
            any_bad = any_bad | c
        seen = batch.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_bad).alias("any"), *[F.count_if(c).alias(f"c{i}") for i, c in enumerate(bad)]).first()
        start = finished_batches(spark, state).agg(F.coalesce(F.sum("rows_in"), F.lit(0))).first()[0]
        found = [(batch_id, start, start + seen["n"], reason, seen[f"c{i}"]) for i, reason in enumerate(checks) if seen[f"c{i}"]]
        if found:  # a row per reason
            spark.createDataFrame(found, ERRORS).coalesce(1).write.mode("overwrite").json(f"{state}/errors/v={batch_id}")
            if mode == "strict":
                raise GateFailed(f"batch {batch_id} has issues: {', '.join(f[3] for f in found)}")
        path = f"{state}/out/v={batch_id}"
        score(batch.where(~any_bad) if mode == "drop" else batch).write.mode("overwrite").parquet(path)
        entry = [(batch_id, start, start + seen["n"], seen["n"], spark.read.parquet(path).count(), seen["any"])]
        spark.createDataFrame(entry, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{state}/manifest/v={batch_id}")

    _drain(stream, per_batch, state)
    done = [r["chunk"] for r in finished_batches(spark, state).select("chunk").collect()]  # a number per batch
    paths = [f"{state}/out/v={k}" for k in sorted(done)]
    if not paths:
        raise ValueError("no batch has arrived")
    return spark.read.option("basePath", f"{state}/out").parquet(*paths).withColumnRenamed("v", "chunk")
