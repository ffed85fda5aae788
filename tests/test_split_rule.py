"""A random split as a rule on the row id against the sorted definition, and what reads it."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit
from quarry.operators import splits as E


def sorted_split(df, row_id, p, seed):
    """(row_id, split) by a plain sort: the first ceil(n * p) rows in (hash, row_id) order, null ids first."""
    rows = df.select(row_id, hash_unit(seed, row_id).alias("h")).orderBy("h", F.col(row_id).asc_nulls_first()).collect()
    k = math.ceil(len(rows) * p)
    return [(r[0], "val" if i < k else "train") for i, r in enumerate(rows)]


@pytest.mark.parametrize("ids,p", [
    ([f"a{i}" for i in range(300)], 0.2), ([i % 7 for i in range(300)], 0.5), ([None] * 40 + [f"a{i % 50}" for i in range(200)], 0.2), ([None] * 9 + ["x"], 0.5)])
def test_rule_equals_the_sorted_split(spark, ids, p):
    kind = "string" if any(isinstance(i, str) for i in ids) else "bigint"
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], f"row_id {kind}, n int").repartition(3)
    want = sorted_split(df, "row_id", p, 42)
    assert Counter(map(tuple, E.split_random(df, "row_id", p, 42).collect())) == Counter(want)
    rule, table = E.random_rule(df, "row_id", p, 42), E.split_random(df, "row_id", p, 42)
    for side in ("train", "val", "other"):  # as the semi join on the id: null ids on no side, an id of both sides on both
        assert sorted(r.n for r in E.apply_split(df, rule, "row_id", side).collect()) == sorted(r.n for r in E.apply_split(df, table, "row_id", side).collect())


def test_a_side_of_the_rule_is_a_filter(spark):
    df = spark.range(1000).select(F.col("id").alias("row_id"))
    plan = E.apply_split(df, E.random_rule(df, "row_id"), "row_id", "train")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Sort" not in plan


def test_a_bundle_reads_its_train_rows_once(spark):
    from quarry.operators import bundle as BU
    read = spark.sparkContext.accumulator(0)

    def seen(v):
        read.add(1)
        return v

    df = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") * 2.0).alias("y"), F.when(F.col("id") % 2 == 0, "p").otherwise("q").alias("c"),
                                 F.udf(seen, "double")((F.col("id") % 7).cast("double")).alias("a"))
    BU.fit_bundle(df, "y", ["a"], ["c"], encoding="frequency")
    assert read.value == 200


def test_newton_adds_up_matrices_in_the_tasks(spark, monkeypatch):
    from quarry.operators import models as G
    calls, plain = [], G.F.sum
    monkeypatch.setattr(G.F, "sum", lambda c: (calls.append(1), plain(c))[1])
    df = spark.range(100).select((F.col("id") % 3).alias("y"), *[F.sin(F.col("id") * (i + 1)).alias(f"x{i}") for i in range(4)])
    G.newton_logistic(df, [f"x{i}" for i in range(4)], "y", 3, 1.0, max_iter=2)
    assert len(calls) <= 4  # not one per entry of the Hessian


def test_visits_leave_a_worker_in_bounded_batches(spark, monkeypatch):
    import numpy as np
    import pyarrow as pa

    from quarry.operators import neighbours as N
    r = np.random.default_rng(0)
    df = spark.createDataFrame([(i, r.normal(size=2).tolist()) for i in range(600)], "row_id long, v array<double>")
    found, plain = {}, type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *a, **k: (found.update({f.__name__: f}), plain(self, f, *a, **k))[1])
    N.nearest_neighbours(df.where("row_id >= 20"), df.where("row_id < 20"), "v", 3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(400), pa.int64()), pa.array(r.normal(size=(400, 2)).tolist(), pa.list_(pa.float64())), pa.array([1e9] * 400)], names=["id", "v", "bound"])
    sizes = [b.num_rows for b in found["further"](iter([batch]))]
    assert max(sizes) <= 4096 and sum(sizes) > 20_000
