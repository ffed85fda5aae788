"""Exact dedup: a tree merge of sorted digest runs.

Every input partition turns its rows into one sorted run of text digests. In round r the lanes that
differ only in digit r exchange runs: a digest goes to the lane whose digit r is the digest's own,
where up to ``fan_in`` sorted runs are merged. After log_fan_in(lanes) rounds a digest has one home
lane, which holds its smallest identifier and its count. Each level keeps one row per digest and lane,
so a text that makes up a third of all rows never sends more than one row per lane.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES
from quarry.session import cut_lineage


def normalised(text: F.Column) -> F.Column:
    """The text with every run of white space as one blank; null is empty. A single blank is left
    alone, which gives the same text and spares the copy."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[\\x09-\\x0D][{SPACES}]*|\\x20[{SPACES}]+", " ")


def text_digest(text: F.Column) -> F.Column:
    """SHA-256 of the normalised text, lowercase hex."""
    return F.sha2(normalised(text), 256)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, so all null, empty and blank-free empty texts form one group (a text of
    blanks only is one blank, another text). A group's keeper is the row with the smallest identifier;
    null identifiers come last and their keep_id is null if a group has no other. If a row is repeated
    with the same identifier, exactly one of the repeats is kept. An empty table gives an empty result;
    other columns, whatever their names, are not read.

    Digests are verified by the normalised text's length, which is part of every key.
    """
    spark = docs.sparkSession
    lanes = fan_in
    while lanes < int(spark.conf.get("spark.sql.shuffle.partitions")):
        lanes *= fan_in
    plain = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    hashed = plain.select("id", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("check"))
    rows = cut_lineage(hashed.select(
        F.struct(F.col("id").isNull().alias("none"), "id", F.monotonically_increasing_id().alias("tag")).alias("me"),
        "digest", "check", F.pmod(F.spark_partition_id(), F.lit(lanes)).alias("lane"),
    ).sortWithinPartitions("digest", "check"))

    # Level 0: what each lane knows of its own rows. Rank by (null last, identifier, row tag).
    level = rows.groupBy("lane", "digest", "check").agg(F.min("me").alias("least"), F.count("*").alias("n"))
    runs = level
    bucket = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(lanes)).cast("int")
    step = 1
    while step < lanes:
        digit = lambda c, s=step: F.pmod(F.floor(c / F.lit(s)), F.lit(fan_in))
        moved = (F.col("lane") + (digit(bucket) - digit(F.col("lane"))) * F.lit(step)).cast("int")
        runs = (
            runs.withColumn("lane", moved)
            .repartition(lanes, "lane")  # min over a struct is a sort aggregate: the runs are merged in key order
            .groupBy("lane", "digest", "check")
            .agg(F.min("least").alias("least"), F.sum("n").alias("n"))
        )
        step *= fan_in
    # Way down: each lane's run learns the answer, then the lane's rows do. A hot digest has one row per
    # lane in the first join and only one lane's rows in the second.
    final = runs.select("digest", "check", "least", F.col("n").alias("group_size"))
    answers = level.select("lane", "digest", "check").join(final, ["digest", "check"])
    out = rows.join(answers, ["lane", "digest", "check"])
    return out.select(F.col("me.id").alias(id_col), F.col("least.id").alias("keep_id"), "group_size",
                      (F.col("me.tag") == F.col("least.tag")).alias("kept"), F.col("digest").alias("text_sha256"))
