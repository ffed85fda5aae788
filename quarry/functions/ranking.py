"""Order-dependent helpers that Spark does not provide directly, built so that no
step moves all rows (or one hot group) into a single task.

* :func:`global_rank` - dense 0..n-1 position under a total order. A range
  partitioned sort plus per-partition row counts (one row per partition) turned
  into offsets. No unpartitioned ``Window``.
* :func:`rank_within_groups` - position inside each group; a hot group is spread
  over many range partitions because the order key continues past the group key.
* :func:`global_cumsum` - running sums under a total order with the same
  offset idea.
* :func:`exact_quantiles` - linear-interpolated quantiles (numpy/DuckDB
  ``quantile_cont`` rule) by counting between sketch brackets, without a sort.
* :func:`topk_per_group` - top-k per group; the partial ``WindowGroupLimit``
  Catalyst inserts keeps at most k rows per group in every map task.
* :func:`long_form` - unpivot features to ``(row_id, feature, value)``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_LOCAL_MASK = (1 << 33) - 1


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _num_parts(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return int(num_partitions)
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(shuffle, spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions than cores
    (e.g. one small file); inputs that are already parallel are left untouched."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df


def first_index_above(value: Column, cutoffs) -> Column:
    """Number of sorted cutoffs <= value, as a short-circuit CASE chain (codegen
    friendly, unlike a lambda over an array). ``cutoffs`` is a list of literals or
    an array column (missing trailing elements compare as NULL and fall through)."""
    if isinstance(cutoffs, Column):
        raise TypeError("use first_index_above_array for array columns")
    expr = None
    for i, c in enumerate(cutoffs):
        cond = value < F.lit(c)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(cutoffs)))


def first_index_above_array(value: Column, arr: Column, max_len: int) -> Column:
    """Same for an array column of at most ``max_len`` sorted elements."""
    expr = None
    for i in range(max_len):
        cond = value < F.try_element_at(arr, F.lit(i + 1))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.size(arr))


def global_rank(df: DataFrame, order_cols: Sequence, rank_col: str = "_rank",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``rank_col`` = 0-based position of each row under ``order_cols``.

    ``order_cols`` must be a total order (add a unique key as the last element);
    then the result is deterministic. Plan: range exchange -> sort within
    partitions -> ``monotonically_increasing_id`` (partition id in the high bits,
    local position in the low 33 bits) -> per-partition counts (one row per
    partition, broadcast) -> offset + local position."""
    order = _cols(order_cols)
    n = _num_parts(df, num_partitions)
    tagged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_mid")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    # One row per partition: bounded by the partition count, safe to broadcast.
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid",
        F.coalesce(
            F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(rank_col, (F.col("_off") + F.col("_loc")).cast("bigint"))
        .drop("_pid", "_loc", "_off")
    )


# Offset tables at most this many rows are broadcast; beyond it they are joined
# with a shuffle (the check is an exact count of an already-aggregated table).
BROADCAST_ROWS = 1_000_000


def _sorted_tagged(df: DataFrame, order: list, n: int) -> DataFrame:
    return (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
        .drop("_mid")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for an aggregated lookup only when its counted size is at most
    ``max_rows``; otherwise the plain frame (shuffle join, where AQE splits skewed
    partitions). The lookup is persisted so the count and the join share one pass."""
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    return F.broadcast(small) if small.count() <= max_rows else small


def join_null_safe(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key meets a null key; ``big``'s key columns stay."""
    right = small.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    cond = None
    for k in keys:
        same = big[k].eqNullSafe(right[f"_key_{k}"])
        cond = same if cond is None else cond & same
    return big.join(right, cond, how).drop(*[f"_key_{k}" for k in keys])


def _join_small(big: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Join an aggregated side, broadcasting it only when its counted size is bounded. Null keys are keys."""
    return join_null_safe(big, bounded_broadcast(small), keys)


def ranked_with_counts(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                       rank_col: str = "_rank", num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with a 0-based in-group position, (group..., _n) sizes).

    One range-partitioned sort on (group, order); per (partition, group) the
    first local position and row count (at most partitions + groups rows) give
    each group's offset in every partition, so a hot group spanning many
    partitions is ranked by many tasks."""
    g = list(group_cols)
    n = _num_parts(df, num_partitions)
    tagged = _sorted_tagged(df, _cols(g + list(order_cols)), n)
    stats = tagged.groupBy("_pid", *g).agg(F.min("_loc").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    wprev = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = stats.select("_pid", *g, "_first", F.coalesce(F.sum("_cnt").over(wprev), F.lit(0)).alias("_off"))
    ranked = (_join_small(tagged, offs, ["_pid", *g])
              .withColumn(rank_col, (F.col("_off") + F.col("_loc") - F.col("_first")).cast("bigint"))
              .drop("_pid", "_loc", "_first", "_off"))
    sizes = stats.groupBy(*g).agg(F.sum("_cnt").alias("_n"))
    return ranked, sizes


def rank_within_groups(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence,
                       rank_col: str = "_rank", num_partitions: int | None = None) -> DataFrame:
    """0-based position inside each group (like ``row_number()-1``) without
    partitioning the work by group. ``group_cols + order_cols`` must be a total order."""
    return ranked_with_counts(df, group_cols, order_cols, rank_col, num_partitions)[0]


def global_cumsum(df: DataFrame, order_cols: Sequence, sum_cols: Sequence[str],
                  suffix: str = "_cum", inclusive: bool = True,
                  num_partitions: int | None = None) -> DataFrame:
    """Running sums of ``sum_cols`` in ``order_cols`` order (total order required).

    Range partitions are summed (one row per partition) and turned into
    offsets; inside a partition a window keyed by the materialised partition id
    adds the local running sum, so each task only sees its own range."""
    order = _cols(order_cols)
    n = _num_parts(df, num_partitions)
    parted = (
        df.repartitionByRange(n, *order)
        .withColumn("_pid", F.spark_partition_id())
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    totals = parted.groupBy("_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    wprev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *[F.coalesce(F.sum(f"_tot_{c}").over(wprev), F.lit(0)).alias(f"_off_{c}") for c in sum_cols]
    )
    frame_end = Window.currentRow if inclusive else -1
    wloc = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, frame_end)
    out = parted.join(F.broadcast(offsets), "_pid")
    for c in sum_cols:
        local = F.coalesce(F.sum(c).over(wloc), F.lit(0))
        out = out.withColumn(f"{c}{suffix}", F.col(f"_off_{c}") + local)
    return out.drop("_pid", *[f"_off_{c}" for c in sum_cols])


#: So many groups' brackets (a short row each) may pass through the driver; more stay on the cluster.
DRIVER_GROUPS = 10_000


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, qs: Sequence[float],
                    accuracy: int = 20_000, small: int = 0) -> DataFrame:
    """Exact linear quantiles per group -> ``(group..., qi, q, value)``.

    Rule (numpy ``linear`` / DuckDB ``quantile_cont``): h = q*(n-1),
    v = v[floor h] + (h - floor h) * (v[ceil h] - v[floor h]). NULL values are ignored, a null group is a group.

    Rank selection by brackets, without a sort of the values: a mergeable sketch gives, per wanted rank, two data
    values that enclose it (rank error at most 1/accuracy of the group). A second pass counts the values between
    the brackets and collapses those inside to (value, count), both with map-side sums; at most 8/accuracy of a
    group's values per quantile remain, and exact positions come from running counts over those. A rank that its
    bracket should not hold raises; it is never guessed. Groups of at most ``small`` values (2 * accuracy at least)
    need no bracket. Both numbers change work only."""
    from quarry.session import cut_lineage
    g, qs = list(group_cols), [float(q) for q in qs]
    small = max(small, 2 * accuracy)  # below it the margin is under six ranks
    k, margin = len(qs), 3.0 / accuracy
    vals = df.select(*g, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ends = [max(0.0, q - margin) for q in qs] + [min(1.0, q + margin) for q in qs]
    fit = vals.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
                               F.percentile_approx("_v", ends, accuracy).alias("_s"))
    few = F.col("_n") <= small
    low = [F.when(few | F.lit(ends[i] == 0.0), F.col("_mn")).otherwise(F.col("_s")[i]) for i in range(k)]
    high = [F.when(few | F.lit(ends[k + i] == 1.0), F.col("_mx")).otherwise(F.col("_s")[k + i]) for i in range(k)]
    h = [F.lit(q) * (F.col("_n") - 1) for q in qs]
    fit = fit.select(*g, F.array(*low).alias("_low"), F.array(*high).alias("_high"),
                                 F.array_sort(F.array(*low, *high)).alias("_cuts"),
                                 F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(q).alias("q"), x.alias("h"), F.floor(x).cast("bigint").alias("lo"),
                                                    F.ceil(x).cast("bigint").alias("hi")) for i, (q, x) in enumerate(zip(qs, h))]).alias("_wanted"))
    rows = fit.limit(DRIVER_GROUPS + 1).collect()
    if len(rows) <= DRIVER_GROUPS:
        lookup = F.broadcast(df.sparkSession.createDataFrame(rows, fit.schema))
    else:
        lookup = cut_lineage(fit)
    j = join_null_safe(vals, lookup.select(*g, "_low", "_high", "_cuts"), g)
    inside = F.lit(False)
    for i in range(k):
        inside = inside | F.col("_v").between(F.col("_low")[i], F.col("_high")[i])
    cell = first_index_above_array(F.col("_v"), F.col("_cuts"), 2 * k)
    kept = j.groupBy(*g, cell.alias("_cell"), F.when(inside, F.col("_v")).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*g).orderBy("_cell", F.col("_v").asc_nulls_last())
    end = F.sum("_c").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = join_null_safe(kept.withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_c")), lookup.select(*g, "_wanted"), g)
    here = lambda p: (p >= F.col("_start")) & (p < F.col("_end"))
    hits = placed.select(*g, "_v", "_start", "_end", F.explode(F.filter("_wanted", lambda s: here(s["lo"]) | here(s["hi"]))).alias("_w"))
    value = lambda p: F.max(F.when(here(F.col(f"_w.{p}")), F.col("_v")))
    out = hits.groupBy(*g, F.col("_w.qi").alias("qi"), F.col("_w.q").alias("q"), F.col("_w.h").alias("_h")).agg(
        value("lo").alias("_vlo"), value("hi").alias("_vhi"), F.count_if(F.col("_v").isNull()).alias("_lost"))
    part = F.col("_h") - F.floor("_h")
    exact = F.when(part == 0, F.col("_vlo")).otherwise(F.col("_vlo") + part * (F.col("_vhi") - F.col("_vlo")))
    exact = F.when(F.col("_lost") > 0, F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")).otherwise(exact)
    return out.select(*g, F.col("qi").cast("int").alias("qi"), "q", exact.alias("value"))


def topk_per_group(df: DataFrame, group_cols: Sequence[str], order_exprs: Sequence[Column], k: int,
                   rank_col: str = "rank") -> DataFrame:
    """Top-k rows per group with a 1-based ``rank_col`` (bigint).

    Written as ``row_number() <= k``; Catalyst plans it with a *partial*
    ``WindowGroupLimit`` before the shuffle (each map task keeps at most k rows
    per group) and a final one after it, so a hot group never reaches a task
    whole. ``order_exprs`` must be a total order inside each group."""
    w = Window.partitionBy(*group_cols).orderBy(*order_exprs)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= k)


def long_form(df: DataFrame, id_cols: Sequence[str], value_cols: Sequence[str], value_type: str = "double",
              feature_col: str = "feature", value_col: str = "value") -> DataFrame:
    """Unpivot ``value_cols`` (cast to ``value_type``) to ``(ids..., feature, value)``."""
    cast = df.select(*id_cols, *[F.col(f"`{c}`").cast(value_type).alias(c) for c in value_cols])
    return cast.unpivot(list(id_cols), list(value_cols), feature_col, value_col)


def approx_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str, qs: Sequence[float],
                     accuracy: int = 10000) -> DataFrame:
    """Opt-in approximate twin of :func:`exact_quantiles` (same output shape): Spark's
    mergeable Greenwald-Khanna sketch per group, bounded memory per task and no sort.
    Relative rank error about 1/accuracy."""
    g = list(group_cols)
    arr = F.percentile_approx(F.col(value_col), [float(q) for q in qs], accuracy)
    agg = df.where(F.col(value_col).isNotNull()).groupBy(*g).agg(arr.alias("_a"))
    return agg.select(*g, F.posexplode("_a").alias("qi", "value")).select(
        *g, F.col("qi").cast("int"), F.element_at(F.array(*[F.lit(float(q)) for q in qs]), F.col("qi") + 1).alias("q"), "value")
