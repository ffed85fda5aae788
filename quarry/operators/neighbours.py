"""Exact k nearest neighbours (G9) by pivot cells and triangle-inequality bounds.

A bounded number of train rows are pivots; every train row lies in the cell of its nearest pivot, every cell has a
radius. A scored row first visits the nearest cells that together hold k rows, which bounds its k-th distance;
then it visits only those other cells whose pivot is nearer than that distance plus the cell's radius, and inside a
cell only rows whose distance to the pivot differs from its own by no more. Large cells, and scored rows that visit
one cell in great numbers, are cut into parts, each pair of parts one group of bounded size; a group gives back k
rows for each scored row, so distances are never all written down."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_unit
from quarry.session import cut_lineage

PIVOTS = 128
PART_ROWS = 20_000  # train rows of a group
VISIT_ROWS = 20_000  # scored rows of a group
VISITS_AT_ONCE = 4_096  # visits, each with its row's vector, that a Python worker holds


def _points(df: DataFrame, row_id: str, features: Sequence[str] | str, extra: Sequence[str] = ()) -> DataFrame:
    """(id, v, extra...) with v the features as doubles; rows with a null, NaN or infinite feature are left out."""
    v = F.col(features).cast("array<double>") if isinstance(features, str) else F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    out = df.select(F.col(row_id).alias("id"), v.alias("v"), *extra)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return out.where(F.col("v").isNotNull() & ~bad)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of a to all of b, one row of a at a time."""
    return np.stack([np.sqrt(((b - x) ** 2).sum(axis=1)) for x in a]) if len(a) else np.zeros((0, len(b)))


def nearest_neighbours(train: DataFrame, scored: DataFrame, features: Sequence[str] | str, k: int = 5, row_id: str = "row_id",
                       pivots: int = PIVOTS, part_rows: int = PART_ROWS, visit_rows: int = VISIT_ROWS) -> DataFrame:
    """(id, neighbour, distance, rank 1..k): the k nearest train rows of every scored row by Euclidean distance, ties
    by the smaller neighbour. ``features``: numeric columns, or one array column of a fixed length. Rows with a
    missing feature take no part on either side; with fewer than k train rows all of them come out. Row ids of the
    train side are unique; the scored rows may be train rows (they then find themselves)."""
    if k < 1:
        raise ValueError("k must be at least 1")
    kind, scored_kind = train.schema[row_id].dataType.simpleString(), scored.schema[row_id].dataType.simpleString()
    base, asked = _points(train, row_id, features), _points(scored, row_id, features)
    centre = [r["v"] for r in base.orderBy(hash_unit(0, "id"), "id").limit(pivots).collect()]  # a bounded number of rows
    empty = train.sparkSession.createDataFrame([], f"id {scored_kind}, neighbour {kind}, distance double, rank int")
    if not centre:
        return empty
    pv, dims = np.array(centre, dtype=float), len(centre[0])

    def assign(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column(1), dims), pv)
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                             names=["id", "v", "cell", "off"])

    base = cut_lineage(base.mapInArrow(assign, f"id {kind}, v array<double>, cell int, off double"))
    cells = {r["cell"]: (r["n"], r["radius"]) for r in base.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("off").alias("radius")).collect()}  # a row a pivot
    used = np.array(sorted(cells))
    rows, radius = np.array([cells[c][0] for c in used]), np.array([cells[c][1] for c in used])
    parts = {int(c): max(1, -(-int(n) // part_rows)) for c, n in zip(used, rows)}
    count = F.element_at(F.create_map(*[F.lit(x) for c, p in parts.items() for x in (c, p)]), F.col("cell"))
    base = base.withColumn("part", F.pmod(hash_unit(1, "id"), count.cast("bigint")).cast("int"))

    def pieces(batch, who, cell, d, bound):
        """The visits of rows ``who`` to cells ``cell``. A row's vector goes along with each of its visits, up to one
        per pivot, so they are handed on a bounded number at a time."""
        for at in range(0, len(who), VISITS_AT_ONCE):
            w, c = who[at:at + VISITS_AT_ONCE], cell[at:at + VISITS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(w)), batch.column(1).take(pa.array(w)), pa.array(used[c].astype(np.int32)), pa.array(d[w, c]), pa.array(bound[w])],
                                             names=["id", "v", "cell", "off", "bound"])

    def first(batches):
        """The nearest cells that hold k rows; never fewer than one."""
        for batch in batches:
            d = _distances(_matrix(batch.column(1), dims), pv[used])
            order = np.argsort(d, axis=1, kind="stable")
            held = np.cumsum(rows[order], axis=1)
            take = held - rows[order] < k
            at = np.flatnonzero(take.ravel())
            who, cell = at // len(used), order.ravel()[at]
            yield from pieces(batch, who, cell, d, np.full(batch.num_rows, np.inf))

    def further(batches):
        """Of rows whose k-th distance is bounded: the cells that may hold a nearer row and were not visited."""
        for batch in batches:
            bound = batch.column(2).to_numpy()
            d = _distances(_matrix(batch.column(1), dims), pv[used])
            order = np.argsort(d, axis=1, kind="stable")
            seen = np.zeros(d.shape, dtype=bool)
            np.put_along_axis(seen, order, np.cumsum(rows[order], axis=1) - rows[order] < k, axis=1)
            limit = (bound * (1 + 1e-12) + 1e-12)[:, None]
            who, cell = np.nonzero(~seen & (d - radius[None, :] <= limit))
            yield from pieces(batch, who, cell, d, bound)

    visit = f"id {scored_kind}, v array<double>, cell int, off double, bound double"
    found = f"id {scored_kind}, neighbour {kind}, distance double"

    def search(key, theirs: pa.Table, ours: pa.Table) -> pa.Table:
        b = theirs.sort_by("off")
        off, x = b.column("off").to_numpy(), _matrix(b.column("v").combine_chunks(), dims) if b.num_rows else np.zeros((0, dims))
        names = b.column("id").combine_chunks()
        rank = pa.compute.rank(names, sort_keys="ascending").to_numpy() if b.num_rows else np.zeros(0, int)
        who, at, dist = [], [], []
        q, q_off, bound = (_matrix(ours.column("v").combine_chunks(), dims) if ours.num_rows else x[:0]), ours.column("off").to_numpy(), ours.column("bound").to_numpy()
        for i in range(len(q) if b.num_rows else 0):
            reach = bound[i] * (1 + 1e-12) + 1e-12
            lo, hi = np.searchsorted(off, q_off[i] - reach), np.searchsorted(off, q_off[i] + reach, "right")
            d = np.sqrt(((x[lo:hi] - q[i]) ** 2).sum(axis=1))
            if len(d) > k:
                some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
            else:
                some = np.arange(len(d))
            some = some[np.lexsort((rank[lo:hi][some], d[some]))[:k]]
            who += [i] * len(some)
            at += (lo + some).tolist()
            dist += d[some].tolist()
        return pa.table({"id": ours.column("id").take(pa.array(who, pa.int64())), "neighbour": names.take(pa.array(at, pa.int64())), "distance": pa.array(dist, pa.float64())})

    def visited(visits: DataFrame) -> DataFrame:
        asking = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
        if not asking:
            return train.sparkSession.createDataFrame([], found)
        lots = F.create_map(*[F.lit(x) for c, n in asking.items() for x in (int(c), max(1, -(-int(n) // visit_rows)))])
        many = F.element_at(lots, F.col("cell"))
        mine = visits.withColumn("lot", F.pmod(hash_unit(2, "id"), many.cast("bigint")).cast("int"))
        mine = mine.withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)))
        other = base.where(F.col("cell").isin([int(c) for c in asking])).withColumn("lot", F.explode(F.sequence(F.lit(0), many - 1)))
        keys = ["cell", "part", "lot"]
        return other.groupBy(*keys).cogroup(mine.groupBy(*keys)).applyInArrow(lambda key, a, b: search(key, a, b), found)

    def best(pairs: DataFrame) -> DataFrame:
        w = Window.partitionBy("id").orderBy("distance", "neighbour")
        return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    visits = cut_lineage(asked.mapInArrow(first, visit))
    near = cut_lineage(best(visited(visits)))
    bounds = near.groupBy("id").agg(F.max("distance").alias("bound"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.select("id", F.when(F.col("n") < k, F.lit(float("inf"))).otherwise(F.col("bound")).alias("bound"))
    more = asked.join(bounds, "id").select("id", "v", "bound").mapInArrow(further, visit)
    every = near.drop("rank").unionByName(visited(cut_lineage(more)))
    return best(every).select("id", "neighbour", "distance", F.col("rank").cast("int").alias("rank"))


def knn_predict(neighbours: DataFrame, train: DataFrame, target: str, task: str = "classification", row_id: str = "row_id") -> DataFrame:
    """(row_id, prediction): the most frequent class among the neighbours (the smaller of equally frequent ones), or
    the mean of their targets."""
    seen = neighbours.join(train.select(F.col(row_id).alias("neighbour"), F.col(target).alias("_y")), "neighbour")
    if task == "regression":
        return seen.groupBy("id").agg(F.avg("_y").alias("prediction")).withColumnRenamed("id", row_id)
    votes = seen.where(F.col("_y").isNotNull()).groupBy("id", "_y").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("id").orderBy(F.desc("_n"), F.col("_y"))  # at most k rows
    return votes.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(F.col("id").alias(row_id), F.col("_y").alias("prediction"))


# ------------------------------------------------------------------ G11: RBF kernel by random Fourier features
def fourier_features(df: DataFrame, features: Sequence[str], gamma: float, components: int = 200, seed: int = 0) -> tuple[DataFrame, list[str]]:
    """``df`` with ``components`` columns whose inner products approach exp(-gamma |x - y|^2): sqrt(2 / components) *
    cos(w x + b) with seeded w and b. Plain column expressions, so the linear models train on them as on any feature."""
    r = np.random.default_rng(seed)
    w = r.normal(scale=np.sqrt(2 * gamma), size=(components, len(features)))
    b = r.uniform(0, 2 * np.pi, size=components)
    names = [f"rff_{i}" for i in range(components)]
    cols = {}
    for i, n in enumerate(names):
        e = F.lit(float(b[i]))
        for f, v in zip(features, w[i]):
            e = e + F.lit(float(v)) * F.col(f"`{f}`")
        cols[n] = F.lit(float(np.sqrt(2 / components))) * F.cos(e)
    return df.withColumns(cols), names


def gamma_scale(df: DataFrame, features: Sequence[str]) -> float:
    """1 / (number of features * variance of all their values)."""
    n = len(features)
    r = df.agg(*[F.avg(F.col(f"`{f}`")).alias(f"m{i}") for i, f in enumerate(features)], *[F.avg(F.col(f"`{f}`") * F.col(f"`{f}`")).alias(f"s{i}") for i, f in enumerate(features)]).first()
    mean = sum(r[f"m{i}"] or 0.0 for i in range(n)) / n
    var = sum(r[f"s{i}"] or 0.0 for i in range(n)) / n - mean * mean
    return 1.0 / (n * var) if var > 0 else 1.0


def fit_rbf_svc(train: DataFrame, features: Sequence[str], label: str, gamma: float | None = None, components: int = 200, seed: int = 0, c: float = 1.0, max_iter: int = 50):
    """RBF support vector classifier (two classes): linear SVC on random Fourier features. Returns (model, names, gamma)."""
    from pyspark.ml.classification import LinearSVC

    from quarry.operators.models import training_input
    gamma = gamma_scale(train, features) if gamma is None else gamma
    ready, names = fourier_features(train, features, gamma, components, seed)
    model = LinearSVC(regParam=1.0 / (c * train.count()), maxIter=max_iter, tol=1e-4, labelCol=label, featuresCol="features").fit(training_input(ready, names, label))
    return model, names, gamma
