"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again.

Every stage but the last returns the columns of its input. Filtering stages treat each row of their input:
repeated rows, null texts and null identifiers have defined results, stated at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.ranking import BROADCAST_ROWS
from quarry.llm.bpe import bpe_tokens
from quarry.llm.common import ship_package, table
from quarry.llm.decontaminate import without_contaminated
from quarry.llm.exact_dedup import exact_dedup, text_digest
from quarry.llm.language_id import UNDECIDED, train_language_model, with_language
from quarry.llm.ngram_join import ngram_components
from quarry.session import brief_shuffles, cut_lineage, scratch_path

#: A text's best language must have this share of probability; below it no language is recognised.
LEAST_SCORE = 0.3


#: Texts are long: an Arrow batch between Spark and a Python worker holds at most this many rows.
BATCH_ROWS = 2000


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(spark.conf.get(key))
    if not 0 < most <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts whose language is recognised. Null texts, texts without a letter, and texts whose best
    language has a probability under LEAST_SCORE go. The model learns from two thirds of the labelled rows."""
    _prepare(spark)
    model = train_language_model(docs)
    if not model.classes:
        return docs  # nothing was learned, so nothing can be rejected
    found = with_language(docs, model, pred_col="__language", score_col="__score",
                          keep=lambda lang, score: (lang != UNDECIDED) & (score >= LEAST_SCORE))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def _without(docs: DataFrame, key: F.Column, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in ``gone`` (one column, ``__gone``). Up to a counted number of keys are broadcast,
    so that the texts stay where they are; only beyond it the rows are shuffled."""
    few = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return docs.join(few, key == F.col("__gone"), "left_anti")


def _row_key(doc_id: F.Column, digest: F.Column) -> F.Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), digest)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of every distinct normalised text: the one with the smallest doc_id; of rows that
    share both, the one whose raw text has the smallest digest. Null texts count as empty. Rows with a null doc_id
    stay only if all of their text's rows have none."""
    _prepare(spark)
    rows = exact_dedup(docs).select(_row_key(F.col("doc_id"), F.col("text_sha256")).alias("__gone"), "kept", "group_size")
    keys = cut_lineage(rows.where("group_size > 1").groupBy("__gone").agg(F.max("kept").alias("kept"), F.count("*").alias("n")))
    key = _row_key(F.col("doc_id"), text_digest(F.col("text")))
    out = _without(docs, key, keys.where("NOT kept").select("__gone"))
    repeats = keys.where("kept AND n > 1").select("__gone")
    if repeats.limit(1).count():  # rows that share doc_id and normalised text: only these are gathered, and thinned before
        few = F.broadcast(repeats) if repeats.count() <= BROADCAST_ROWS else repeats
        same = out.select("*", key.alias("__key")).join(few.withColumnRenamed("__gone", "__key"), "__key", "left_semi")
        raw = F.sha2(F.coalesce("text", F.lit("")), 256)
        one = same.groupBy("__key").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), F.struct(F.col("text").isNull(), raw)).alias("__row"))
        out = _without(out, key, repeats).unionByName(one.select(*[F.col(f"__row.`{c}`") for c in docs.columns]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by 5-word shingles (Jaccard 0.75 or more): the one with the
    smallest doc_id, a null one last. Texts without words stay. Rows that share both doc_id and text are one
    document, all of whose rows stay or go; rows that share only a doc_id are different documents. Documents are
    told apart by 128 bits of hashes; those that share the 64 bits by which they are joined (a few in 10**10) stay."""
    _prepare(spark)
    document, check = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit("check"), "doc_id", "text")
    groups = ngram_components(docs.select(document.alias("__document"), F.col("text")), "__document").select("__document", "component_id").distinct()
    known = docs.select(document.alias("__document"), check.alias("__check"), F.col("doc_id")).groupBy("__document").agg(
        F.min("__check").alias("__check"), F.max("__check").alias("__other"), F.min("doc_id").alias("doc_id"))
    name = lambda a, b: F.concat_ws(":", a.cast("string"), b.cast("string"))
    with brief_shuffles(spark):
        members = cut_lineage(groups.join(known.where("__check = __other"), "__document"))
        kept = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__document"))).alias("least"))
        gone = members.join(kept.select("least.__document"), "__document", "left_anti")
        gone = cut_lineage(gone.select(name(F.col("__document"), F.col("__check")).alias("__gone")))
    return _without(docs, name(document, check), gone)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the rows whose text holds a passage of ``benchmark``, whatever their doc_id; all others stay."""
    _prepare(spark)
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of every document."""
    _prepare(spark)
    return bpe_tokens(docs, with_ids=True).drop("decoded")


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding", bpe_stage),
]

#: The language model, the shingle components and the tokens have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    path = scratch_path(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
    return docs
