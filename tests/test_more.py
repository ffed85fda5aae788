"""Invariants for sources, scoring, ensembles and streaming."""

import math

from pyspark.sql import functions as F

from conftest import SMALL
from quarry.operators import evaluate as H
from quarry.operators import scoring as I
from quarry.plans.views import pred_m, reg, table
from quarry.sources import io as A
from quarry.streaming import scoring as L


def test_fingerprint_is_order_insensitive_and_changes_on_edit(spark):
    li = table(spark, SMALL, "lineitem")
    a = A.table_fingerprint(li).first().fingerprint
    b = A.table_fingerprint(li.orderBy(F.col("l_quantity").desc()).repartition(3)).first().fingerprint
    c = A.table_fingerprint(li.withColumn("l_tax", F.when(F.col("l_orderkey") == 0, 9.9).otherwise(F.col("l_tax")))).first().fingerprint
    assert a == b and a != c


def test_score_conditions_ids_and_errors(spark):
    r = reg(spark, SMALL)
    out = I.score_conditions(r, "row_id", ["quantity"], F.col("discount")).toPandas()
    assert sorted(out.condition_id) == list(range(1, len(out) + 1))
    assert (out[out.status == "failed"].prediction.isna()).all()


def test_input_search_respects_space(spark):
    r = reg(spark, SMALL).select("row_id")
    space = {"x": {"type": "int", "low": 3, "high": 7}, "y": {"type": "float", "low": 0.0, "high": 1.0, "step": 0.25},
             "c": {"choices": ["a", "b"]}}
    out = I.input_search(r, "row_id", space, lambda d: F.col("x") + F.col("y"), k=5).toPandas()
    assert len(out) == 5 and out.x.between(3, 7).all() and set(out.y) <= {0.0, 0.25, 0.5, 0.75, 1.0}
    assert math.isclose(out.objective.max(), 8.0)


def test_topk_classes_tie_prefers_higher_index(spark):
    df = spark.createDataFrame([(1, [0.4, 0.4, 0.2])], "id long, proba array<double>")
    row = df.select(*I.topk_classes(F.col("proba"), ["a", "b", "c"], 2)).first()
    assert row.top1_label == "b" and row.top2_label == "a"


def test_stream_sample_equals_batch_bottom_n(spark, tmp_path):
    ev = table(spark, SMALL, "events")
    s = L.stream_sample(L.file_stream(spark, SMALL, ev.schema, glob="events.parquet").select("event_id", "value"), "event_id", 50, str(tmp_path))
    from quarry.operators.profile import sample_rows
    b = sample_rows(ev.select("event_id", "value"), "event_id", 50)
    assert sorted(r.event_id for r in s.collect()) == sorted(r.event_id for r in b.collect())


def test_poisson_weights_have_mean_one(spark):
    cdf = H.poisson1_cdf()
    assert math.isclose(cdf[0], math.exp(-1)) and cdf[-1] <= 1.0 + 1e-12
    df = spark.range(20000).select(F.col("id").alias("row_id"), F.lit(1.0).alias("y_true"), F.lit(1.0).alias("y_pred"))
    out = H.bootstrap_ci(df, "mae", n_boot=8).first()
    assert out.n_boot == 8 and out.low == 0.0 and out.high == 0.0


def test_ensemble_predict_argmax(spark):
    from quarry.operators import leaderboard as J
    pm = pred_m(spark, SMALL)
    out = J.ensemble_predict({"a": pm.select("row_id", "proba"), "b": pm.select("row_id", "proba")}, 3)
    joined = out.join(pm.select("row_id", F.col("y_pred").alias("ref")), "row_id")
    assert joined.where(F.col("y_pred") != F.col("ref")).count() == 0


def test_gate_fail_mode_raises_on_exact_leak(spark):
    import pytest
    from quarry.operators.quality import dq_gate
    from quarry.plans.views import leak
    with pytest.raises(RuntimeError):
        dq_gate(leak(spark, SMALL), "fail", target="target", ids=["record_id"])
    status, reasons = dq_gate(leak(spark, SMALL), "warn", target="target", ids=["record_id"])
    assert status == "fail" and "leak" in reasons


def test_preprocess_knows_every_encoding_and_refuses_others(spark):
    import pytest
    from quarry.operators.preprocess import ENCODINGS, preprocess_fit_transform
    rows = [(i, float(i % 7), None if i % 11 == 0 else f"v{i % 4}", float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id bigint, num double, cat string, target double")
    split = df.selectExpr("row_id", "CASE WHEN row_id % 5 = 0 THEN 'val' ELSE 'train' END AS split")
    for e in ENCODINGS:
        out = preprocess_fit_transform(df, split, "row_id", ["num"], ["cat"], "target", encoding=e)
        assert any(c.startswith("cat__") for c in out.columns) and out.count() == 60
        assert out.select([c for c in out.columns if c.startswith("cat__")]).dropna().count() == 60
    with pytest.raises(ValueError):
        preprocess_fit_transform(df, split, "row_id", ["num"], ["cat"], "target", encoding="ordnal")


def test_drift_treats_nan_as_missing_and_infinity_as_outside(spark):
    from quarry.operators import drift as D
    nan, inf = float("nan"), float("inf")
    rows = [(float(i),) for i in range(80)] + [(nan,)] * 10 + [(None,)] * 5 + [(inf,), (-inf,)]
    df = spark.createDataFrame(rows, "x double")
    p = D.profile_numeric(df, ["x"]).first()
    assert (p["count"], p.missing_count) == (82, 15) and p["mean"] is None and p["max"] is None and p.p50 == 39.5
    edges = D.hist_edges(df, ["x"]).first().edges
    assert edges[0] == 0.0 and edges[-1] == 79.0
    assert sum(r["count"] for r in D.hist_counts(df, ["x"], D.hist_edges(df, ["x"])).collect()) == 80


def test_scan_directory_reads_both_formats(spark, tmp_path):
    import pytest
    from quarry.sources.io import scan_directory
    spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string").coalesce(1).write.parquet(f"{tmp_path}/d/p")
    spark.createDataFrame([(i, "x") for i in range(5)], "k int, v string").coalesce(1).write.option("header", True).csv(f"{tmp_path}/d/c")
    assert scan_directory(spark, f"{tmp_path}/d").count() == 8
    with pytest.raises(Exception):
        scan_directory(spark, f"{tmp_path}/d/nothing")


def test_small_mends(spark):
    from pyspark.sql import functions as F
    from quarry.operators.leaderboard import recommend_tiebreak
    from quarry.operators.preprocess import auto_encodings
    from quarry.operators.quality import dq_gate, dq_leak_correlation, dq_name_suspects
    from quarry.operators.scoring import input_search
    board = spark.createDataFrame([("b", "r1", None, "ensemble", 1), ("b", "r2", None, "single", 2)], "board string, run_id string, composite double, family string, rank int")
    assert [r.run_id for r in recommend_tiebreak(board).where("pick").collect()] == ["r1"]
    df = spark.createDataFrame([(f"v{i % 50}",) for i in range(100)] + [(None,)], "c string")
    assert auto_encodings(df, ["c"]) == {"c": "onehot"}
    assert {r.column for r in dq_name_suspects(spark.createDataFrame([], "label_x int, mine_y int"), leak_patterns=["mine"]).collect()} == {"label_x", "mine_y"}
    assert dq_gate(df, "disable") == ("skipped", []) and dq_gate(df, "no") == ("skipped", [])
    assert dq_leak_correlation(spark.createDataFrame([("a", 1.0)], "s string, t double"), "t").columns == ["column", "corr", "flagged"]
    best = input_search(spark.range(4), "id", {"a": {"type": "float", "low": 0.0, "high": 1.0}},
                        lambda d: F.when(F.col("id") == 2, F.lit(float("inf"))).otherwise(F.col("id").cast("double")), k=2)
    assert [r.id for r in best.collect()] == [3, 1]


def test_streams_go_on_after_a_restart(spark, tmp_path):
    """Two files, a stop, two more files, a new start on the same state: as if run in one go."""
    from quarry.streaming import scoring as L

    def files(path, ks):
        for k in ks:
            spark.range(k * 100, k * 100 + 100).selectExpr("id AS event_id", "CAST(id % 97 AS DOUBLE) AS value").coalesce(1).write.mode("append").parquet(path)
        return L.file_stream(spark, path, "event_id bigint, value double")

    runs = {
        "sample": lambda s, st: L.stream_sample(s, "event_id", 20, st),
        "totals": lambda s, st: L.stream_issue_totals(s, F.when(F.col("value") > 50, "high"), st),
        "chunks": lambda s, st: L.stream_chunk_stats(s, F.col("value") > 50, st),
        "score": lambda s, st: L.run_to_files(L.stream_score(s, ["event_id"], F.col("value") * 2), st),
    }
    for name, run in runs.items():
        once = sorted(map(tuple, run(files(f"{tmp_path}/{name}-a", range(4)), f"{tmp_path}/{name}-a-state").collect()))
        run(files(f"{tmp_path}/{name}-b", range(2)), f"{tmp_path}/{name}-b-state")
        twice = sorted(map(tuple, run(files(f"{tmp_path}/{name}-b", range(2, 4)), f"{tmp_path}/{name}-b-state").collect()))
        assert once == twice and once


def test_recommendation_prefers_source_then_single_then_rank(spark):
    from quarry.operators.leaderboard import recommend_topk
    rows = [("b", "r1", 0.9, "ensemble", 1, "valid"), ("b", "r2", 0.8, "single", 2, "train"), ("b", "r3", 0.7, "single", 3, "valid"), ("b", "r4", 0.6, "single", 4, None)]
    df = spark.createDataFrame(rows, "board string, run_id string, composite double, family string, rank int, source string")
    pick = lambda **k: [r.run_id for r in recommend_topk(df, 3, **k).orderBy("place").collect()]
    assert pick() == ["r2", "r3", "r4"]
    assert pick(source_col="source") == ["r3", "r4"]
    assert pick(allow_ensemble=True) == ["r1", "r2", "r3"]


def test_event_batches_have_many_files_and_every_row(spark, tmp_path, monkeypatch):
    from quarry.plans import q_misc as M
    monkeypatch.setattr(M, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    ids = [*range(9000), *[None] * 7]
    rows = spark.createDataFrame([(i, float(k % 100)) for k, i in enumerate(ids)], "event_id bigint, value double")
    rows.repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    M._over_event_batches(spark, str(tmp_path), lambda s: L._drain(
        s, lambda b, i: seen.append((i, len(list(tmp_path.glob("event-files/*.parquet"))), b.count(), b.where("event_id is null").count())), f"{tmp_path}/state"))
    assert [x[0] for x in seen] == [0, 1, 2, 3] and all(x[1] > i + 1 for i, x in enumerate(seen))
    assert [x[2] for x in seen] == [3000, 2000, 2000, 2007] and [x[3] for x in seen] == [0, 0, 0, 7]
    monkeypatch.undo()
    assert M.q_stream_score(spark, str(tmp_path)).count() == len(ids)
    assert M.q_stream_chunks(spark, str(tmp_path)).agg(F.sum("rows")).first()[0] == len(ids)
