"""Bootstrap sums against plain Python."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions.md5 import md5_words, numbered_hashes
from quarry.operators import evaluate as H
from quarry.operators import resample as R


def _wide(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


@pytest.mark.parametrize("head", ["0:", "a seed of so many characters that the message needs a second block:"])
def test_numbered_hashes_are_md5(head):
    for a, b in ((0, 1200), (99_990, 100_010), (7_199_999_990, 7_200_000_005)):
        got = np.concatenate(list(numbered_hashes(head.encode(), a, b))).tolist()
        assert got == [_wide(f"{head}{i}") for i in range(a, b)]


def test_words_of_rows_that_differ_in_the_middle():
    rows = np.frombuffer(b"abcxyz", np.uint8).reshape(2, 3)
    words = md5_words(b"head", rows, b"tail")
    for i, middle in enumerate(("abc", "xyz")):
        digest = hashlib.md5(f"head{middle}tail".encode()).digest()
        assert [int(w[i]) for w in words] == [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def test_poisson_weights_match_the_digits():
    keys, cdf = ["0:a", "0:longer", "0", "0:b", "0:" + "é" * 40], H.poisson1_cdf()
    got = R.poisson_weights([k.encode() for k in keys], 50, cdf)
    for row, key in zip(got.tolist(), keys):
        digests = [hashlib.md5(f"{key}:{b}".encode()).hexdigest() for b in range(13)]
        u = [int(d[8 * j : 8 * j + 8], 16) / 2**32 for d in digests for j in range(4)]
        assert row == [sum(c <= x for c in cdf) for x in u[:50]]


def test_gaps_round_trip():
    for places in ([0], [R.BLOCK - 1], [0, 0, 5, 5, 400, R.BLOCK - 1]):
        raw, size = R.packed_gaps(np.array(places))
        assert R.places_of(raw, len(places), size).tolist() == places


ROWS = [(i, float(i * 7 % 13) if i % 11 else None, float(i % 5) if i % 17 else None) for i in range(300)]


@pytest.mark.parametrize("metric", ["rmse", "mae", "accuracy", "r2"])
def test_draws_with_replacement(spark, monkeypatch, metric):
    """Blocks and pieces smaller than the table, null labels and predictions among the rows."""
    df = spark.createDataFrame(ROWS, "row_id int, y double, p double").repartition(5)
    order, n, reps = sorted(ROWS), len(ROWS), []
    for rep in range(6):
        drawn = [order[_wide(f"3:{d}") % n] for d in range(rep * n, (rep + 1) * n)]
        both = [(y, p) for _, y, p in drawn if y is not None and p is not None]
        ys = [y for _, y, _ in drawn if y is not None]
        sse = sum((y - p) ** 2 for y, p in both)
        reps.append({"rmse": math.sqrt(sse / len(both)), "mae": sum(abs(y - p) for y, p in both) / len(both),
                     "accuracy": sum(y == p for y, p in both) / len(both), "r2": 1 - sse / (np.var(ys) * n)}[metric])
    got = H.bootstrap_ci(df, metric, "row_id", "y", "p", n_boot=6, seed=3, method="multinomial").first()
    assert got["n_boot"] == 6
    assert got["low"] == pytest.approx(np.quantile(reps, 0.025)) and got["high"] == pytest.approx(np.quantile(reps, 0.975))


def test_draws_travel_packed(spark):
    """A replicate's draws are a row per piece and block of rows, not a row per draw."""
    n = 3 * R.BLOCK
    sent = R._draws(spark, b"0:", n, 4).select("block", "rep", "n", F.length("a").alias("bytes")).collect()
    assert len(sent) == 12 and sum(r["n"] for r in sent) == 4 * n and sum(r["bytes"] for r in sent) < 2 * n
