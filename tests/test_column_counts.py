"""Column counts and quality rules against plain Python."""

from pyspark.sql import functions as F

from quarry.operators import quality as D


def test_column_counts_without_combining(spark, monkeypatch):
    """Columns of mostly different values take the dealt-out path; zeros of both signs differ, NaN is missing."""
    monkeypatch.setattr(D, "COMBINED", 5)
    rows = [(f"k{i % 190}", float(i), None if i % 3 else "x", [0.0, -0.0, float("nan")][i % 3]) for i in range(200)]
    got = {r[0]: r[3:] for r in D.column_counts(spark.createDataFrame(rows, "id string, v double, s string, z double"))}
    assert got == {"id": (200, 190, 0), "v": (200, 200, 0), "s": (200, 2, 133), "z": (200, 3, 66)}
    assert D.column_counts(spark.createDataFrame([], "id string")) == []


def test_rows_that_differ_by_the_place_of_a_null(spark):
    rows = [("x", None), (None, "x"), ("x", None), (None, None)]
    got = D.dq_duplicates(spark.createDataFrame(rows, "a string, b string")).first()
    assert (got["rows"], got["duplicates"]) == (4, 1)
    floats = [(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,)]
    assert D.dq_duplicates(spark.createDataFrame(floats, "a double")).first()["duplicates"] == 2


def test_rules_take_each_measure_once(spark, monkeypatch):
    calls = []
    for name in ("column_counts", "dq_duplicates", "dq_mixed_types", "leak_suspects"):
        monkeypatch.setattr(D, name, lambda *a, f=getattr(D, name), n=name, **k: calls.append(n) or f(*a, **k))
    df = spark.createDataFrame([(i, f"r{i}", float(i), float(i)) for i in range(40)], "n int, record_id string, x double, target double")
    got = D.dq_summary(df, "target", ids=["record_id"]).first()
    assert sorted(calls) == ["column_counts", "dq_duplicates", "dq_mixed_types", "leak_suspects"]
    assert (got["rows"], got["high_cardinality_count"], got["leak_error"], got["quality_status"]) == (40, 2, True, "fail")


def test_numbers_keep_their_bucket(spark):
    texts = ["1", " 2.5 ", "1e3", "-7d", "NaN", "inf", "0x1p3", "1:2:3", "2001-01-02", "TRUE", "abc", "1,5"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.trim("t").try_cast("double").isNotNull()
    for r in df.select("t", D.value_bucket("t").alias("b"), plain.alias("number")).collect():
        assert (r["b"] == "number") == r["number"], r
