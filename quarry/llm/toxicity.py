"""Toxicity by cumulative-link ordinal regression on sparse text features.

P(grade >= k) = sigmoid(w.x - t_k): one weight vector for all thresholds t_1 < t_2 < ... A text's features
are its words and their first letters, counted as log(1 + n). The score is the expected grade.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ChunkMemo, row_fraction, texts_of

WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
MEMO_ENTRIES = 400_000


def word_features(word: str) -> list[str]:
    """A word and, marked by a star, its prefixes: insults come with many endings."""
    return [word, *[word[:n] + "*" for n in PREFIXES if len(word) > n]]


class OrdinalRegression:
    """Weights per feature and ascending thresholds."""

    def __init__(self, features: list[str], grades: int):
        self.index = {f: i for i, f in enumerate(features)}
        self.weights = np.zeros(len(features))
        self.thresholds = np.arange(1, grades, dtype=float) - 0.5

    def fit(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, grades: np.ndarray, l2: float = 1e-3,
            steps: int = 300, rate: float = 0.05) -> None:
        """Full-batch Adam on the likelihood of the grades. The sparse matrix is given by its entries. The
        thresholds are the first one and logarithms of their gaps, which keeps them in order."""
        n, k = len(grades), len(self.thresholds)
        free = np.concatenate([self.weights, [self.thresholds[0]], np.log(np.maximum(np.diff(self.thresholds), 1e-3))])
        first, second = np.zeros_like(free), np.zeros_like(free)
        for step in range(1, steps + 1):
            w, gaps = free[: len(self.weights)], np.exp(free[len(self.weights) + 1 :])
            t = free[len(self.weights)] + np.concatenate([[0.0], np.cumsum(gaps)])
            z = np.bincount(rows, values * w[cols], minlength=n)
            up = np.concatenate([np.ones((n, 1)), _sigmoid(z[:, None] - t), np.zeros((n, 1))], 1)  # P(grade >= j)
            slope = up * (1 - up)
            a = np.arange(n)
            p = np.maximum(up[a, grades] - up[a, grades + 1], 1e-12)
            dz = -(slope[a, grades] - slope[a, grades + 1]) / p / n
            gw = np.bincount(cols, values * dz[rows], minlength=len(w)) + l2 * w
            gt = np.zeros(k + 2)
            np.add.at(gt, grades, slope[a, grades] / p / n)
            np.add.at(gt, grades + 1, -slope[a, grades + 1] / p / n)
            gt = gt[1:-1]
            tail = np.cumsum(gt[::-1])[::-1]
            g = np.concatenate([gw, [gt.sum()], tail[1:] * gaps])
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            free -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        self.weights = free[: len(self.weights)]
        self.thresholds = free[len(self.weights)] + np.concatenate([[0.0], np.cumsum(np.exp(free[len(self.weights) + 1 :]))])

    def at_least(self, z: np.ndarray) -> np.ndarray:
        """(texts, thresholds): P(grade >= 1), P(grade >= 2), ..."""
        return _sigmoid(z[:, None] - self.thresholds)

    def scorer(self):
        """A function from texts to w.x, with a memo of words."""
        index = self.index
        memo = ChunkMemo(lambda words: [tuple(i for f in word_features(w) if (i := index.get(f)) is not None) for w in words], MEMO_ENTRIES)

        def score(texts: list[str]) -> np.ndarray:
            out = np.zeros(len(texts))
            for k, text in enumerate(texts):
                words = WORD.findall(text.lower())
                known = memo.values(set(words))
                found = Counter([i for w in words if known[w] for i in known[w]])
                out[k] = sum(self.weights[i] * np.log1p(n) for i, n in sorted(found.items()))
            return out

        return score


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def toxicity_samples(docs: DataFrame, labels: DataFrame, per_class: int = 4000, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "toxic") -> DataFrame:
    """(text, toxic 0/1): about ``per_class`` labelled documents of each class by a hash of the identifier,
    one of each text. Rows without identifier, text or label are no samples."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1))
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, per_class / max(1, counts.get(1, 0)))).otherwise(min(1.0, per_class / max(1, counts.get(0, 0))))
    chosen = known.where(row_fraction(F.lit("toxicity"), F.col("id")) < share)  # at most about 2 * per_class rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    return texts.join(F.broadcast(chosen), "id").groupBy(F.sha2("text", 256)).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def train_toxicity(samples: DataFrame, features: int = 4096, support: int = 4, least_g2: float = 12.0) -> OrdinalRegression:
    """Grades are 0 for a clean sample and 1 or 2 for a toxic one: 2 if it holds more words that mark toxic
    samples than half of the toxic ones do (the labels know only 0 and 1). A word or prefix is a feature if
    ``support`` samples have it and its G-squared test against the label exceeds ``least_g2``; the
    strongest ``features`` are used. The samples are bounded, and so is all that the driver reads."""
    def count(batches):
        n = Counter()
        for batch in batches:
            for text, toxic in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                n.update({(f, toxic) for w in set(WORD.findall(text.lower())) for f in word_features(w)})
        keys = list(n)
        yield pa.RecordBatch.from_pydict({"f": pa.array([k[0] for k in keys], pa.string()), "toxic": pa.array([k[1] for k in keys], pa.int32()),
                                          "n": pa.array([n[k] for k in keys], pa.int64())})

    total = {r.toxic: r.n for r in samples.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = total.get(1, 0), total.get(0, 0)
    if not n1 or not n0:
        return OrdinalRegression([], 3)
    per = samples.select("text", "toxic").mapInArrow(count, "f string, toxic int, n bigint").groupBy("f").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    a, b, s = F.col("a").cast("double"), F.col("b").cast("double"), F.col("a") + F.col("b")
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    g2 = 2 * (term(a, s * n1 / (n1 + n0)) + term(b, s * n0 / (n1 + n0)) + term(n1 - a, n1 - s * n1 / (n1 + n0)) + term(n0 - b, n0 - s * n0 / (n1 + n0)))
    best = per.where(s >= support).select("f", g2.alias("g2"), (a / n1 > 10 * (b + 0.5) / n0).alias("marker")).where(F.col("g2") > least_g2)
    best = best.orderBy(F.desc("g2"), "f").limit(features).collect()
    model = OrdinalRegression([r.f for r in best], 3)
    index, markers = model.index, {r.f for r in best if r.marker}

    def featurise(batches):
        for batch in batches:
            ids, counts, marks = [], [], []
            for text in texts_of(batch.column(0)):
                words = WORD.findall(text.lower())
                n = Counter(i for w in words for f in word_features(w) if (i := index.get(f)) is not None)
                ids.append(sorted(n))
                counts.append([n[i] for i in sorted(n)])
                marks.append(sum(any(f in markers for f in word_features(w)) for w in words))
            yield pa.RecordBatch.from_pydict({"ids": pa.array(ids, pa.list_(pa.int32())), "n": pa.array(counts, pa.list_(pa.int32())),
                                              "toxic": batch.column(1), "marks": pa.array(marks, pa.int64())})

    got = samples.select("text", "toxic").mapInArrow(featurise, "ids array<int>, n array<int>, toxic int, marks bigint").toArrow()
    got = got.take(pa.compute.sort_indices(pa.table({"k": [str(x) for x in zip(*(got.column(c).to_pylist() for c in ("toxic", "ids", "n")))]}), [("k", "ascending")]))
    toxic, marks = got.column("toxic").to_numpy(), got.column("marks").to_numpy()
    grades = np.where(toxic == 1, 1 + (marks > np.median(marks[toxic == 1])), 0)
    ids, sizes = got.column("ids").to_pylist(), got.column("n").to_pylist()
    rows = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    cols = np.array([i for x in ids for i in x], dtype=np.int64)
    model.fit(rows, cols, np.log1p(np.array([i for x in sizes for i in x], dtype=float)), grades)
    return model


def score_toxicity(docs: DataFrame, model: OrdinalRegression, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id_col, expected_severity (0 to the highest grade), grade (the most severe with a
    probability of at least one half), toxic (P(grade >= 1) > ``limit``).

    Null and empty texts are scored as texts without features; without training samples of both classes
    every text gets the model's start value and toxic false. Repeated rows stay; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        score = own.scorer()
        for batch in batches:
            up = own.at_least(score(texts_of(batch.column(1))))
            toxic = (up[:, 0] > limit) & bool(own.index)
            yield pa.RecordBatch.from_pydict({
                id_col: batch.column(0), "expected_severity": pa.array(up.sum(1)), "grade": pa.array((up >= 0.5).sum(1).astype(np.int64)),
                "toxic": pa.array(toxic)})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"`{id_col}` {kind}, expected_severity double, grade bigint, toxic boolean")
