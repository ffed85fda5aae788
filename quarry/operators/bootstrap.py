"""Bootstrap intervals of probability metrics (H20): ROC AUC, average precision, log-loss, F1 and accuracy.

Every row has a Poisson(1) weight in every replicate: a 60-bit md5 number of the row times an odd 64-bit md5
number of the replicate, whose upper bits pick the weight. The weights of all replicates are one vector, so
all of them ride in the same pass: sums of vectors per task for the plain metrics; for the ranking metrics, running
sums of vectors in score order. Rows are range-partitioned by score once; a partition reports its totals, and
the sum of the totals before it is its offset. Rows of one score that come many at a time are added up before
the exchange, so that a hot score does not meet in one task row by row."""

from __future__ import annotations

import hashlib
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_wide
from quarry.operators.evaluate import EPS, average_precision, poisson1_cdf, roc_auc
from quarry.session import cut_lineage

RANKED, SUMMED = ("roc_auc", "pr_auc"), ("log_loss", "f1", "accuracy")
TOGETHER = 32  # rows of one score in a batch that travel as one
ROWS_AT_ONCE = 4096


def replicate_factors(seed, n_boot: int) -> np.ndarray:
    """An odd 64-bit number per replicate."""
    return np.array([int(hashlib.md5(f"{seed}:replicate:{k}".encode()).hexdigest()[:16], 16) | 1 for k in range(n_boot)], dtype=np.uint64)


def row_weights(base: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Poisson(1) weights, a row per row and a column per replicate."""
    mixed = base.astype(np.uint64)[:, None] * factors[None, :]
    return np.searchsorted(np.array(poisson1_cdf()), (mixed >> np.uint64(32)) / 4294967296.0, side="right")


def _summed(rows: DataFrame, metric: str, factors: np.ndarray) -> np.ndarray:
    """The metric per replicate; rows: base, y (0/1), s (probability of class 1)."""
    def run(batches):
        total = np.zeros((4, len(factors)))
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                base, y, s = (c.to_numpy(zero_copy_only=False) for c in batch.slice(a, ROWS_AT_ONCE).columns)
                w = row_weights(base, factors)
                if metric == "log_loss":
                    p, q = np.clip(s, EPS, 1 - EPS), np.clip(1 - s, EPS, 1 - EPS)
                    parts = [np.ones(len(y)), -np.log(np.where(y == 1, p, q) / (p + q))]
                else:
                    hit = s >= 0.5
                    parts = [np.ones(len(y)), (hit == (y == 1)), hit & (y == 1), hit != (y == 1)]
                total[: len(parts)] += np.stack([np.asarray(x, dtype=float) for x in parts]) @ w
        yield pa.RecordBatch.from_pydict({"part": pa.array([0, 1, 2, 3], pa.int32()), "v": pa.array(total.tolist())})

    got = rows.mapInArrow(run, "part int, v array<double>").select("part", F.posexplode("v").alias("k", "x"))
    sums = np.zeros((4, len(factors)))
    for r in got.groupBy("part", "k").agg(F.sum("x").alias("x")).collect():  # four numbers a replicate
        sums[r["part"], r["k"]] = r["x"]
    with np.errstate(invalid="ignore", divide="ignore"):
        if metric == "f1":
            return np.where(2 * sums[2] + sums[3] == 0, 0.0, 2 * sums[2] / (2 * sums[2] + sums[3]))
        return sums[1] / sums[0]


def _ranked(rows: DataFrame, metric: str, factors: np.ndarray) -> np.ndarray:
    n = len(factors)

    def gather(batches):
        for batch in batches:
            base, y, s = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            order = np.argsort(s, kind="stable")
            base, y, s = base[order], y[order], s[order]
            first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, int)
            count = np.diff(np.append(first, len(s)))
            single = np.repeat(count < TOGETHER, count)
            none = pa.nulls(int(single.sum()), pa.binary())
            yield pa.RecordBatch.from_pydict({"s": pa.array(s[single]), "base": pa.array(base[single]), "y": pa.array(y[single]), "pos": none, "neg": none})
            many = np.flatnonzero(count >= TOGETHER)
            if len(many):
                pos, neg = [], []
                for k in many.tolist():
                    sums = np.zeros((2, n), dtype="<i4")
                    for a in range(first[k], first[k] + count[k], ROWS_AT_ONCE):
                        b = min(a + ROWS_AT_ONCE, first[k] + count[k])
                        w = row_weights(base[a:b], factors)
                        sums[0] += w[y[a:b] == 1].sum(axis=0).astype("<i4")
                        sums[1] += w[y[a:b] != 1].sum(axis=0).astype("<i4")
                    pos.append(sums[0].tobytes())
                    neg.append(sums[1].tobytes())
                yield pa.RecordBatch.from_pydict({"s": pa.array(s[first[many]]), "base": pa.nulls(len(many), pa.int64()), "y": pa.nulls(len(many), pa.int32()),
                                                  "pos": pa.array(pos, pa.binary()), "neg": pa.array(neg, pa.binary())})

    def vectors(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and weights of the positive and the negative rows."""
        s = part.column(0).to_numpy()
        plain = part.column(1).is_valid().to_numpy(zero_copy_only=False)
        pos, neg = np.zeros((len(s), n)), np.zeros((len(s), n))
        if plain.any():
            w = row_weights(part.column(1).filter(pa.array(plain)).to_numpy(), factors)
            hit = (part.column(2).filter(pa.array(plain)).to_numpy() == 1)[:, None]
            pos[plain], neg[plain] = w * hit, w * ~hit
        for k in np.flatnonzero(~plain).tolist():
            pos[k], neg[k] = (np.frombuffer(part.column(c)[k].as_buffer(), dtype="<i4", count=n) for c in (3, 4))
        return s, pos, neg

    def parts(batches):
        """Groups of equal scores, in order: (positive, negative) weight vectors; the last one is held back
        until its score ends."""
        held = None
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                s, pos, neg = vectors(batch.slice(a, ROWS_AT_ONCE))
                first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
                gp, gn = np.add.reduceat(pos, first, axis=0), np.add.reduceat(neg, first, axis=0)
                if held is not None and held[0] == s[0]:
                    gp[0] += held[1]
                    gn[0] += held[2]
                elif held is not None:
                    gp, gn = np.vstack([held[1], gp]), np.vstack([held[2], gn])
                held = s[-1], gp[-1], gn[-1]
                if len(gp) > 1:
                    yield gp[:-1], gn[:-1]
        if held is not None:
            yield held[1][None, :], held[2][None, :]

    shards = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.mapInArrow(gather, "s double, base bigint, y int, pos binary, neg binary").repartitionByRange(shards, "s").sortWithinPartitions("s")
    dealt = cut_lineage(dealt)  # the ranges must be the same in both passes

    def totals(batches):
        p, q = np.zeros(n), np.zeros(n)
        for gp, gn in parts(b.select(["s", "base", "y", "pos", "neg"]) for b in ids(batches)):
            p, q = p + gp.sum(axis=0), q + gn.sum(axis=0)
        if own:
            yield pa.RecordBatch.from_pydict({"shard": pa.array(own[:1], pa.int32()), "p": pa.array([p.tolist()]), "q": pa.array([q.tolist()])})

    own: list[int] = []

    def ids(batches):
        own.clear()
        for b in batches:
            if b.num_rows:
                own[:] = [b.column("shard")[0].as_py()]
                yield b

    numbered = dealt.select("s", "base", "y", "pos", "neg", F.spark_partition_id().alias("shard"))
    sums = {r["shard"]: (np.array(r["p"]), np.array(r["q"])) for r in numbered.mapInArrow(totals, "shard int, p array<double>, q array<double>").collect()}
    before, p, q = {}, np.zeros(n), np.zeros(n)
    for shard in sorted(sums):  # a row per range
        before[shard] = p, q
        p, q = p + sums[shard][0], q + sums[shard][1]
    every = p, q

    def score(batches):
        total = np.zeros(n)
        below = None
        for gp, gn in parts(b.select(["s", "base", "y", "pos", "neg"]) for b in ids(batches)):
            if below is None:
                below = [v.copy() for v in before[own[0]]]
            cp, cn = below[0] + np.cumsum(gp, axis=0) - gp, below[1] + np.cumsum(gn, axis=0) - gn
            if metric == "roc_auc":
                total += (gp * (cn + 0.5 * gn)).sum(axis=0)
            else:  # from this score upwards
                tp, fp = every[0] - cp, every[1] - cn
                total += np.where(gp > 0, gp * tp / np.maximum(tp + fp, 1e-300), 0.0).sum(axis=0)
            below = [below[0] + gp.sum(axis=0), below[1] + gn.sum(axis=0)]
        yield pa.RecordBatch.from_pydict({"v": pa.array([total.tolist()])})

    total = np.zeros(n)
    for r in numbered.mapInArrow(score, "v array<double>").collect():  # a row per range
        total += np.array(r["v"])
    with np.errstate(invalid="ignore", divide="ignore"):
        return total / (p * q) if metric == "roc_auc" else total / p


def bootstrap_ci_proba(df: DataFrame, metric: str = "roc_auc", row_id: str = "row_id", y: str = "y_true", score: str = "p", n_boot: int = 200,
                       alpha: float = 0.05, seed: int = 0) -> DataFrame:
    """Percentile interval of a binary probability metric: metric, low, mid (point estimate), high, n_boot (replicates
    that count: those without a positive or a negative row are skipped). F1 and accuracy take 0.5 as threshold.
    Rows without a label or score take no part; repeated row ids have the same weights."""
    if metric not in RANKED + SUMMED:
        raise ValueError(f"bootstrap metric '{metric}' not supported")
    plain = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    rows = plain.select(hash_wide(seed, row_id).alias("base"), F.col(y).cast("int").alias("y"), F.col(score).cast("double").alias("s"))
    factors = replicate_factors(seed, n_boot)
    reps = (_ranked if metric in RANKED else _summed)(rows, metric, factors)
    reps = reps[np.isfinite(reps)]
    if metric == "roc_auc":
        mid = roc_auc(plain, y, score).first()[0]
    elif metric == "pr_auc":
        mid = average_precision(plain, y, score).first()[0]
    else:
        p, hit = F.col(score).cast("double"), (F.col(score) >= 0.5)
        one, pc, qc = F.col(y) == 1, F.least(F.greatest(p, F.lit(EPS)), F.lit(1 - EPS)), F.least(F.greatest(1 - p, F.lit(EPS)), F.lit(1 - EPS))
        mid = plain.agg({"log_loss": -F.avg(F.ln(F.when(one, pc).otherwise(qc) / (pc + qc))), "accuracy": F.avg((hit == one).cast("double")),
                         "f1": F.try_divide(2.0 * F.count_if(hit & one), 2.0 * F.count_if(hit & one) + F.count_if(hit != one))}[metric]).first()[0]
    low, high = (float(np.quantile(reps, q)) if len(reps) else None for q in (alpha / 2, 1 - alpha / 2))
    return df.sparkSession.createDataFrame([(metric, low, mid, high, len(reps))], "metric string, low double, mid double, high double, n_boot bigint")


def bootstrap_ci_multiclass(df: DataFrame, n_classes: int, metrics: Sequence[str] = ("roc_auc", "pr_auc", "log_loss", "f1_macro"), row_id: str = "row_id",
                            y: str = "y_true", proba: str = "proba", n_boot: int = 200, alpha: float = 0.05, seed: int = 0) -> DataFrame:
    """The same for ``proba`` arrays and labels 0..n-1: log-loss of the true class, and the mean over classes of one
    class against the rest for ROC AUC, average precision and F1 (of the most probable class, the first of equal ones).
    A replicate counts if every class has a value."""
    plain = df.where(F.col(y).isNotNull() & F.col(proba).isNotNull())
    factors, base = replicate_factors(seed, n_boot), hash_wide(seed, row_id).alias("base")
    own = F.element_at(proba, (F.col(y) + 1).cast("int")).cast("double")
    best = F.array_position(proba, F.array_max(proba)) - 1
    rows = []
    for metric in metrics:
        if metric == "log_loss":
            reps = [_summed(plain.select(base, F.lit(1).alias("y"), own.alias("s")), "log_loss", factors)]
            mid = [plain.agg(-F.avg(F.ln(F.least(F.greatest(own, F.lit(EPS)), F.lit(1 - EPS))))).first()[0]]
        else:
            reps, mid = [], []
            for k in range(n_classes):
                of = plain.select(row_id, base, (F.col(y) == k).cast("int").alias("y"),
                                  (F.col(proba)[k].cast("double") if metric != "f1_macro" else (best == k).cast("double")).alias("s"))
                kind = {"f1_macro": "f1"}.get(metric, metric)
                reps.append((_ranked if kind in RANKED else _summed)(of.select("base", "y", "s"), kind, factors))
                one = bootstrap_mid(of, kind)
                mid.append(one)
        reps = np.mean(reps, axis=0)
        reps = reps[np.isfinite(reps)]
        low, high = (float(np.quantile(reps, q)) if len(reps) else None for q in (alpha / 2, 1 - alpha / 2))
        rows.append((metric, low, float(np.mean(mid)) if None not in mid else None, high, len(reps)))
    return df.sparkSession.createDataFrame(rows, "metric string, low double, mid double, high double, n_boot bigint")


def bootstrap_mid(rows: DataFrame, metric: str):
    """Point estimate over rows of y and s."""
    if metric == "roc_auc":
        return roc_auc(rows, "y", "s").first()[0]
    if metric == "pr_auc":
        return average_precision(rows, "y", "s").first()[0]
    hit, one = F.col("s") >= 0.5, F.col("y") == 1
    wrong = F.count_if(hit != one)
    return rows.agg(F.coalesce(F.try_divide(2.0 * F.count_if(hit & one), 2.0 * F.count_if(hit & one) + wrong), F.lit(0.0))).first()[0]
