"""Boosting on cells of equal bins against MLlib on the rows."""

import random

import pytest
from pyspark.ml.regression import GBTRegressor

from quarry.operators.models import assemble, fit_mllib, training_input


@pytest.fixture(scope="module")
def rows(spark):
    r, out = random.Random(3), []
    for _ in range(24_000):  # more than the 10 000 rows that MLlib samples; many zeros
        a, b, c = r.choice([0.0, r.gauss(0, 3)]), float(r.randrange(-4, 40)), float(r.randrange(2))
        out.append((a, b, c, 2 * a + (5 if a > 1 else 0) + b * c + r.gauss(0, 1)))
    return spark.createDataFrame(out, ["_f0", "_f1", "_f2", "y"]).repartition(3)


NAMES = ["_f0", "_f1", "_f2"]


@pytest.mark.parametrize("params", [dict(maxIter=6, maxDepth=3, stepSize=0.3), dict(maxIter=4, maxDepth=5, stepSize=0.1, maxBins=12, minInfoGain=0.01)])
def test_cells_give_the_trees_of_the_rows(rows, params, tmp_path):
    got = fit_mllib(rows, NAMES, "y", "gradient_boosting", "regression", params=params)
    est = GBTRegressor(seed=42, labelCol="y", featuresCol="features", **params)
    want = est.fit(training_input(rows, NAMES, "y"))
    number = lambda m: [[float(w) for w in line.replace("(", " ").replace(")", " ").split() if w.lstrip("-")[:1].isdigit()]
                        for t in m.trees for line in t.toDebugString.splitlines()[1:]]
    assert len(got.trees) == len(want.trees) and got.treeWeights == want.treeWeights
    assert [pytest.approx(x, rel=1e-9, abs=1e-9) for x in number(want)] == number(got)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
    assert got.getMaxBins() == est.getMaxBins() and got.getOrDefault("labelCol") == "y"
    got.write().overwrite().save(str(tmp_path / "m"))
    back = type(got).load(str(tmp_path / "m")).transform(assemble(rows, NAMES)).select("_f0", "_f1", "_f2", "y", "prediction")
    own = want.transform(assemble(rows, NAMES)).select("_f0", "_f1", "_f2", "y", "prediction")
    assert [r.prediction for r in back.orderBy(*NAMES, "y").collect()] == pytest.approx([r.prediction for r in own.orderBy(*NAMES, "y").collect()])


def test_rows_are_passed_over_a_fixed_number_of_times(spark, rows):
    """What the rounds pass over are the cells: fewer than the rows, however often the rows come."""
    counts = {}
    for times in (1, 20):
        seen = []
        fit = GBTRegressor.fit
        GBTRegressor.fit = lambda self, data, *a: (seen.append(data.count()), fit(self, data, *a))[1]
        try:
            many = rows.selectExpr("round(_f0) _f0", "_f1", "_f2", "y", f"explode(sequence(1, {times})) k").drop("k")
            fit_mllib(many, NAMES, "y", "gradient_boosting", "regression", params=dict(maxIter=2))
        finally:
            GBTRegressor.fit = fit
        counts[times] = seen
    assert len(counts[1]) == len(counts[20]) == 1 and counts[20][0] <= 32 * 32 * 2 < 24_000


def test_odd_rows(spark):
    one = spark.createDataFrame([(1.0, 2.0)] * 5, ["x", "y"])  # nothing to split
    m = fit_mllib(one, ["x"], "y", "gradient_boosting", "regression", params=dict(maxIter=2))
    assert m.transform(assemble(one, ["x"])).first().prediction == pytest.approx(2.0)
    for bad in ([(float("nan"), 1.0)], [(None, 1.0)], [(1.0, None)], [(float("inf"), 1.0)]):
        with pytest.raises(Exception):
            fit_mllib(spark.createDataFrame([(1.0, 2.0), (2.0, 3.0), *bad], "x double, y double"), ["x"], "y", "gradient_boosting", "regression", params=dict(maxIter=2))
    with pytest.raises(Exception):
        fit_mllib(one.limit(0), ["x"], "y", "gradient_boosting", "regression")
