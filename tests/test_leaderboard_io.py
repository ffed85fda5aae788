"""Leaderboard and source/sink invariants."""

from pyspark.sql import functions as F

from conftest import SMALL
from quarry.operators import evaluate as H
from quarry.operators import leaderboard as J
from quarry.plans.views import pred_m, reg, runs
from quarry.sources import io as A


def test_rank_is_dense_per_board_and_ordered(spark):
    r = runs(spark, SMALL)
    ranked = J.leaderboard_rank(J.composite_score(J.normalize_minmax(J.metrics_long(r, ["r2", "rmse", "mae", "mse"]))))
    pdf = ranked.toPandas()
    for _, g in pdf.groupby("board"):
        assert sorted(g["rank"]) == list(range(1, len(g) + 1))
        top = g.sort_values("rank")
        assert list(top["composite"]) == sorted(top["composite"], reverse=True)


def test_minmax_norm_in_unit_interval(spark):
    long = J.metrics_long(runs(spark, SMALL), ["r2", "rmse"])
    out = J.normalize_minmax(long).toPandas()
    assert out["norm"].between(0, 1).all()


def test_chunk_ranges_cover_all_rows(spark):
    r = reg(spark, SMALL)
    ch = A.chunk_ranges(r, "row_id", 1000).toPandas().sort_values("chunk")
    n = r.count()
    assert ch["rows"].sum() == n and ch["row_start"].iloc[0] == 0 and ch["row_end"].iloc[-1] == n
    assert (ch["row_end"].iloc[:-1].to_numpy() == ch["row_start"].iloc[1:].to_numpy()).all()


def test_csv_round_trip_keeps_rows_and_nulls(spark):
    r = reg(spark, SMALL).select("row_id", "quantity")
    path = A.shared_scratch(spark, "t-csv")
    A.sink(r, path, "csv")
    back = A.scan_csv(spark, path, "row_id string, quantity double")
    assert back.count() == r.count()
    assert back.where(F.col("quantity").isNull()).count() == r.where(F.col("quantity").isNull()).count()


def test_confusion_matrix_is_full_grid(spark):
    pm = pred_m(spark, SMALL)
    cm = H.confusion_matrix(pm).toPandas()
    assert len(cm) == 9 and cm["count"].sum() == pm.count()
    for _, g in cm.groupby("y_true"):
        assert abs(g["rate"].sum() - 1.0) < 1e-9
