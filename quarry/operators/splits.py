"""Train/validation splits.

Every split is a ``(row_id, split)`` table. Membership is decided by a seeded
md5 order (reproducible in any engine) and exact sizes come from the
distributed rank helper, so there is no single-partition window even when one
class or one time range holds most rows. Guarantees: sizes, disjointness,
group integrity, class proportion and seed determinism (not the reference's
exact Mersenne-twister membership)."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit
from quarry.functions.ranking import bounded_broadcast, global_rank, join_null_safe, rank_within_groups

#: The cut of a random split is looked for among the ranges of the hash that share so many first bits.
HASH_BITS = 16


def _check(p: float):
    if not 0 < p < 1:
        raise ValueError("test_size must be in (0, 1)")


def _n_val(n: int, p: float) -> int:
    if n < 2:
        raise ValueError("need at least 2 rows to split")
    k = math.ceil(n * p)
    if k <= 0 or k >= n:
        raise ValueError("split leaves one side empty")
    return k


# ------------------------------------------------------------------ E1
class RandomSplit(NamedTuple):
    """A random split as a rule on the row id: rows before the cut, in (hash, row id) order, are validation. A side is
    a filter of the rows themselves, without a sort, a table of all ids or a join."""
    row_id: str
    id_type: str
    seed: int
    cut_hash: int
    cut_id: object  # the last validation row's id, null ones first
    cut_rows: int   # rows with that id
    cut_val: int    # how many of them are validation (at least one)

    def _places(self) -> tuple[Column, Column, Column, Column]:
        """A row's hash, the cut's, and among rows of the cut's hash whether the id comes before the cut's or is it. The
        hash is dear: the sides ask for it once of most rows."""
        key, cut = F.col(f"`{self.row_id}`"), F.lit(self.cut_id).cast(self.id_type)
        before = F.lit(False) if self.cut_id is None else key.isNull() | (key < cut)
        return hash_unit(self.seed, key), F.lit(self.cut_hash), before, key.eqNullSafe(cut)

    def side(self, name: str) -> Column:
        """Whether a row's id has a row on side train or val (both where the cut runs through equal ids). Null ids are
        on neither, as in a join on the id."""
        h, cut, before, at = self._places()
        if name == "val":
            mine = (h <= cut) & ((h < cut) | before | at)
        elif name == "train":
            mine = (h > cut) | ((h == cut) & ~before & (~at if self.cut_val == self.cut_rows else F.lit(True)))
        else:
            mine = F.lit(False)
        return F.col(f"`{self.row_id}`").isNotNull() & mine

    def table(self, df: DataFrame) -> DataFrame:
        """(row_id, split) of every row of ``df``, the rows that the rule was made from."""
        h, cut_hash, before, at = self._places()
        split = F.when((h <= cut_hash) & ((h < cut_hash) | before | at), F.lit("val")).otherwise(F.lit("train")).alias("split")
        if self.cut_val == self.cut_rows:
            return df.select(self.row_id, split)
        cut = df.sparkSession.range(self.cut_rows).select(  # equal rows: any cut_val of them
            F.lit(self.cut_id).cast(self.id_type).alias(self.row_id), F.when(F.col("id") < self.cut_val, F.lit("val")).otherwise(F.lit("train")).alias("split"))
        return df.where(~at).select(self.row_id, split).unionByName(cut)


def random_rule(df: DataFrame, row_id: str, test_size: float = 0.2, seed: int = 42) -> RandomSplit:
    """The rule of :func:`split_random`. Two passes over the ids: counts of the hash's ranges, then of the ids in the
    range that holds the cut (1 in 65 536; equal ids are one row); only these counts reach the driver."""
    _check(test_size)
    keys = df.select(row_id).withColumn("_h", hash_unit(seed, row_id))
    cell_of = F.shiftright(F.col("_h"), 32 - HASH_BITS).cast("int")
    cells = sorted(tuple(r) for r in keys.groupBy(cell_of.alias("c")).agg(F.count(F.lit(1))).collect())
    k = _n_val(sum(n for _, n in cells), test_size)
    seen = 0
    for cell, n in cells:
        if seen + n >= k:
            break
        seen += n
    some = keys.where(cell_of == F.lit(cell))
    for value, h, n in some.groupBy(row_id, "_h").agg(F.count(F.lit(1)).alias("_n")).orderBy("_h", row_id).collect():
        if seen + n >= k:
            return RandomSplit(row_id, df.schema[row_id].dataType.simpleString(), seed, h, value, n, k - seen)
        seen += n
    raise RuntimeError("the rows changed between the two passes of a split")


def split_random(df: DataFrame, row_id: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """First ceil(n*p) rows in md5(seed:row_id) order are validation."""
    return random_rule(df, row_id, test_size, seed).table(df)


# ------------------------------------------------------------------ E2
def split_group(df: DataFrame, row_id: str, group_col: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """ceil(p * n_groups) whole groups (md5 order) are validation. Rows without a group form one group."""
    _check(test_size)
    groups = df.select(group_col).distinct().withColumn("_h", hash_unit(seed, group_col))
    k = _n_val(groups.count(), test_size)
    g = global_rank(groups, ["_h", group_col], "_r").select(
        group_col, F.when(F.col("_r") < k, F.lit("val")).otherwise(F.lit("train")).alias("split"))
    # one row per group: broadcast when the counted group table is small, else a
    # shuffle join (AQE splits a skewed hot group)
    return join_null_safe(df.select(row_id, group_col), bounded_broadcast(g), [group_col]).select(row_id, "split")


# ------------------------------------------------------------------ E3
def split_stratified(df: DataFrame, row_id: str, label: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Per class, the first ceil(n_c * p) rows in md5 order are validation (>= 2 classes). Rows without a
    label are a class of their own."""
    _check(test_size)
    keys = df.select(row_id, label).withColumn("_h", hash_unit(seed, row_id))
    sizes = keys.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    if sizes.count() < 2:
        raise ValueError("stratified split needs at least 2 classes")
    r = rank_within_groups(keys, [label], ["_h", row_id], "_r")
    r = join_null_safe(r, bounded_broadcast(sizes), [label])  # one row per class, size-checked
    val = F.col("_r") < F.ceil(F.col("_n") * F.lit(test_size))
    return r.select(row_id, F.when(val, F.lit("val")).otherwise(F.lit("train")).alias("split"))


# ------------------------------------------------------------------ E4
def split_time(df: DataFrame, row_id: str, time_col: str, test_size: float = 0.2) -> DataFrame:
    """Stable ascending time order; the last ceil(n*p) rows are validation."""
    _check(test_size)
    n = df.count()
    k = _n_val(n, test_size)
    r = global_rank(df.select(row_id, time_col), [time_col, row_id], "_r")
    return r.select(row_id, F.when(F.col("_r") >= n - k, F.lit("val")).otherwise(F.lit("train")).alias("split"))


# ------------------------------------------------------------------ E6 / E7
def apply_split(df: DataFrame, split: DataFrame | RandomSplit, row_id: str, side: str = "train") -> DataFrame:
    """Rows of one side: a filter if the split is a rule, else a semi join on the row id."""
    if isinstance(split, RandomSplit):
        return df.where(split.side(side))
    return df.join(split.where(F.col("split") == side).select(row_id), row_id, "left_semi")


def split_counts(split: DataFrame, strategy: str) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(strategy).alias("strategy"), "split", "rows")


# ------------------------------------------------------------------ E8
def kfold_assign(df: DataFrame, row_id: str, k: int = 5, seed: int = 42, label: str | None = None) -> DataFrame:
    """Fold 0..k-1: md5 bucket, or (stratified) round-robin over the md5 order inside each class
    (rows without a label are a class of their own)."""
    if k < 2:
        raise ValueError("k must be >= 2")
    if label is None:
        return df.select(row_id, F.pmod(hash_unit(seed, row_id), F.lit(k)).alias("fold"))
    keys = df.select(row_id, label).withColumn("_h", hash_unit(seed, row_id))
    r = rank_within_groups(keys, [label], ["_h", row_id], "_r")
    return r.select(row_id, F.pmod(F.col("_r"), F.lit(k)).alias("fold"))
