"""Connected components by alternating large and small stars, on the cluster alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of ``links``: label is the smallest node of its component. Rounds go on
    until no link changes; only counts reach the driver. Null ends and self-links are ignored."""
    edges = cut_lineage(links.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where(F.col("u") != F.col("v")).distinct())
    state = None
    while True:
        # Large star: every node sends its larger neighbours to its smallest one (or itself).
        both = edges.unionAll(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))  # u's neighbour v
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        # Small star: every node sends its smaller neighbours, and itself, to the smallest of them.
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = cut_lineage(small.select("e.v", "e.u").where("u != v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    labels = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return cut_lineage(labels.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct())
