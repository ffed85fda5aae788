"""Operator invariants in the style of the reference's smoke tests."""

import math

from pyspark.sql import functions as F

from conftest import SMALL
from quarry.operators import drift as K
from quarry.operators import evaluate as H
from quarry.operators import quality as D
from quarry.operators import splits as E
from quarry.plans.views import cls, leak, reg


def test_psi_of_table_with_itself_is_zero(spark):
    r = reg(spark, SMALL)
    rep = K.drift_report(r, r, ["quantity", "price"], ["returnflag"]).collect()
    assert all(abs(x.psi) < 1e-12 for x in rep)
    assert all(x.status == "ok" for x in rep)


def test_shifted_prices_warn(spark):
    r = reg(spark, SMALL)
    # an in-range shift (values outside the train edges are dropped, as in the reference)
    low = r.where(F.col("price") < r.approxQuantile("price", [0.3], 0.0)[0])
    rep = {x.feature: x for x in K.drift_report(r, low, ["price"], []).collect()}
    assert rep["price"].status == "warn"


def test_missing_column_status(spark):
    r = reg(spark, SMALL)
    rep = {x.feature: x for x in K.drift_report(r, r.drop("tax"), ["tax"], []).collect()}
    assert rep["tax"].status == "missing"


def test_perfect_scores(spark):
    df = spark.createDataFrame([(i % 2, float(i % 2) * 0.8 + 0.1) for i in range(100)], "y_true long, p double")
    assert math.isclose(H.roc_auc(df).first()[0], 1.0)
    assert math.isclose(H.average_precision(df).first()[0], 1.0)


def test_split_sizes_and_disjointness(spark):
    r = reg(spark, SMALL)
    n = r.count()
    sp = E.split_random(r, "row_id", 0.2, 42)
    counts = {x.split: x["count"] for x in sp.groupBy("split").count().collect()}
    assert counts["val"] == math.ceil(n * 0.2) and counts["train"] == n - counts["val"]
    assert sp.select("row_id").distinct().count() == n


def test_group_split_keeps_groups_whole(spark):
    r = reg(spark, SMALL)
    sp = E.split_group(r, "row_id", "l_orderkey", 0.2, 42).join(r.select("row_id", "l_orderkey"), "row_id")
    assert sp.groupBy("l_orderkey").agg(F.countDistinct("split").alias("k")).where("k > 1").count() == 0


def test_exact_leak_is_an_error(spark):
    rules = {(x.type, x.severity): x["count"] for x in D.dq_evaluate(leak(spark, SMALL), "target", "regression", ["record_id"]).collect()}
    assert rules[("leak", "fail")] >= 1
    assert ("constant_columns", "warn") in rules


def test_stratified_keeps_class_shares(spark):
    c = cls(spark, SMALL)
    sp = E.split_stratified(c, "row_id", "status", 0.2, 42).join(c.select("row_id", "status"), "row_id")
    for row in sp.groupBy("status").agg(F.avg((F.col("split") == "val").cast("double")).alias("share")).collect():
        assert abs(row.share - 0.2) < 0.02


def test_entry_runs(spark):
    import __spark_entry__ as E2
    out = E2.entry(spark)
    assert out.count() >= 0
    assert set(out.columns) >= {"feature", "psi", "status"}
