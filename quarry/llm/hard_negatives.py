"""Hard negatives: for each anchor and positive, the highest-scoring rows of other labels inside a window below the
positive's score.

Anchors of one label are joined by a minimum spanning tree of their distances. An anchor's score with a
candidate differs from its parent's by at most the edge's length times the candidate's norm; going down the
tree, only candidates whose bounds reach the anchor's window are scored again, all others keep bounds alone.
The first pass finds each anchor's best rows of its own label (window: what could still enter the best), the
second the negatives (window: from the lowest to the highest the positives ask for, raised as rows are found).

Rows are packed into chunks of candidates and blocks of anchors of a bounded number of rows; each chunk
meets each block once, spread over all tasks, and a task gives back only its best rows of each anchor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.ranking import topk_per_group
from quarry.llm.vectors import dimension_of, scaled
from quarry.session import cut_lineage

SCALE, LIMIT = 256, 1 << 22
PACKED = ["x", "tags", "none", "ids", "labels"]
TREE = 1024  # anchors of a spanning tree


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Parent (-1 for the root) and edge length of every row, and the rows level by level from the root: Prim's
    minimum spanning tree of Euclidean distances, from the row nearest to the mean."""
    n = len(x)
    parent, edge, depth = np.full(n, -1), np.zeros(n), np.zeros(n, dtype=int)
    at = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    near, link, left = np.full(n, np.inf), np.full(n, at), np.ones(n, dtype=bool)
    left[at] = False
    for _ in range(n - 1):
        d = np.sqrt(((x - x[at]) ** 2).sum(axis=1))
        closer = left & (d < near)
        near[closer], link[closer] = d[closer], at
        at = int(np.where(left, near, np.inf).argmin())
        parent[at], edge[at], depth[at], left[at] = link[at], near[at], depth[link[at]] + 1, False
    order = np.argsort(depth, kind="stable")
    return parent, edge, np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def window_scores(x: np.ndarray, tree, candidates: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(anchor, places of candidates, exact scores) for every anchor; all candidates whose score lies in
    [low, high] of the anchor are among the places. ``x`` and ``candidates`` are whole numbers."""
    parent, edge, levels = tree
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for depth, level in enumerate(levels):
        scores = None
        for place, v in enumerate(level.tolist()):
            if depth:
                slack = edge[v] * norms * (1 + 1e-12) + 1  # rounding
                least, most = bounds[parent[v]]
                least, most = least - slack, most + slack
                need = np.flatnonzero((most >= low[v]) & (least <= high[v]))
            else:
                least = most = np.zeros(len(candidates))
                need = np.arange(len(candidates))
            if 4 * len(need) >= len(candidates):
                if scores is None:  # most are needed: the whole level in one product
                    scores = x[level] @ candidates.T
                found = scores[place][need]
            else:
                found = candidates[need] @ x[v]
            if len(need) == len(candidates):
                least = most = found
            else:
                least, most = least.copy(), most.copy()
                least[need] = most[need] = found
            bounds[v] = least, most
            inside = (found >= low[v]) & (found <= high[v])
            yield v, need[inside], found[inside]
        for v in set(parent[level].tolist()) if depth else ():
            del bounds[v]


class _Best:
    """The best ``k`` (score, identifier, tag) of one anchor and window so far; the null identifier comes last."""

    def __init__(self, k: int):
        self.k, self.rows = k, np.zeros((0, 4), dtype=np.int64)  # -score, identifier is null, identifier, tag

    def least(self) -> float:
        return -self.rows[-1, 0] if len(self.rows) == self.k else -np.inf

    def add(self, scores: np.ndarray, none: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> None:
        if len(scores) > self.k:
            enough = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            keep = scores >= max(enough, self.least())
            scores, none, ids, tags = scores[keep], none[keep], ids[keep], tags[keep]
        if len(scores):
            rows = np.concatenate([self.rows, np.stack([-scores.astype(np.int64), none.astype(np.int64), ids, tags], axis=1)])
            self.rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))[: self.k]]


def _exact(x: np.ndarray) -> np.ndarray:
    """Doubles where products of such rows are exact in them, else long integers."""
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.float64) if most * most * max(1, x.shape[-1]) < 1 << 52 else x


def _packed(rows: DataFrame, dims: int, chunk_rows: int) -> DataFrame:
    """Rows of (tag, id, label, vec) that take part, many to a packed row, sorted by label."""
    def run(batches):
        held: list[tuple] = []

        def pack():
            tags, none, ids, labels, x = (np.concatenate(c) for c in zip(*held))
            order = np.argsort(labels, kind="stable")
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([int(tags[0])]), "size": pa.array([len(tags)]), "x": pa.array([x[order].astype("<i4").tobytes()], pa.binary()),
                **{k: pa.array([c[order].astype("<i8").tobytes()], pa.binary()) for k, c in (("tags", tags), ("none", none), ("ids", ids), ("labels", labels))}})

        for batch in batches:
            at, x = scaled(batch.column(3), dims, SCALE, LIMIT)
            ids = batch.column(1).take(pa.array(at))
            rows = (batch.column(0).to_numpy()[at], ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False),
                    batch.column(2).to_numpy(zero_copy_only=False)[at].astype(np.int64), x)
            for a in range(0, len(at), chunk_rows):
                held.append(tuple(c[a : a + chunk_rows] for c in rows))
                if sum(len(h[0]) for h in held) >= chunk_rows:
                    yield pack()
                    held.clear()
        if held:
            yield pack()

    return rows.select("tag", "id", "label", "vec").mapInArrow(
        run, "chunk bigint, size bigint, x binary, tags binary, none binary, ids binary, labels binary")


def _unpacked(row: dict, dims: int):
    long = lambda name: np.frombuffer(row[name], dtype="<i8")
    return long("tags"), long("none"), long("ids"), long("labels"), np.frombuffer(row["x"], dtype="<i4").reshape(-1, dims).astype(np.int64)


def _pairs(chunks: DataFrame, anchors: DataFrame, blocks: int, spread: int) -> DataFrame:
    """Every chunk of candidates behind every block of anchors, in partitions that begin a block with the
    block itself. Each block is copied ``spread`` times, so that its chunks lie in as many partitions."""
    salt = F.pmod(F.xxhash64("chunk"), F.lit(spread)).cast("int").alias("salt")
    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    names = [*PACKED, "asked"]
    empty = [F.lit(None).cast("binary").alias("asked")]
    have = anchors if "asked" in anchors.columns else anchors.select("*", *empty)
    copies = have.select("block", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("salt"), F.lit(0).alias("kind"), *names)
    many = chunks.select("*", *empty, salt, F.explode(numbers).alias("block")).select("block", "salt", F.lit(1).alias("kind"), *names)
    return copies.unionAll(many).repartition(spread, "block", "salt").sortWithinPartitions("block", "salt", "kind")


def _trees(labels: np.ndarray, x: np.ndarray):
    """(label, places, tree) of the anchors' spanning trees: one label each, at most TREE anchors."""
    cuts = np.flatnonzero(np.diff(labels)) + 1
    for part in np.split(np.arange(len(labels)), cuts):
        for a in range(0, len(part), TREE):
            places = part[a : a + TREE]
            yield int(labels[places[0]]), places, spanning_tree(x[places].astype(np.float64))


def _search(pairs: DataFrame, dims: int, k: int, windows: int, negatives: bool) -> DataFrame:
    """Each task's best rows: (anchor tag, window, then -score, identifier and tag of the row found)."""
    def run(batches):
        block, state = None, None

        def give():
            of, rows = [], []
            for a, best in enumerate(state["best"]):
                for j, b in enumerate(best):
                    of += [(state["tags"][a], j)] * len(b.rows)
                    rows.append(b.rows)
            rows = np.concatenate(rows) if rows else np.zeros((0, 4), dtype=np.int64)
            return pa.RecordBatch.from_pydict({
                "anchor": pa.array([int(t) for t, _ in of], pa.int64()), "window": pa.array([j for _, j in of], pa.int32()), "score": pa.array(-rows[:, 0]),
                "id": pa.array(rows[:, 2], mask=rows[:, 1] == 1), "tag": pa.array(rows[:, 3])})

        for batch in batches:
            for row in batch.to_pylist():
                if not row["kind"]:
                    if row["block"] == block:
                        continue
                    if state is not None:
                        yield give()
                    block = row["block"]
                    tags, _, _, labels, x = _unpacked(row, dims)
                    state = {"tags": tags, "trees": list(_trees(labels, x)), "x": _exact(x), "best": [[_Best(k) for _ in range(windows)] for _ in tags]}
                    if negatives:
                        asked = np.frombuffer(row["asked"], dtype="<i8").reshape(-1, windows)
                        state["low"], state["high"] = -(-asked // 2), asked * 95 // 100  # 50p <= 100n <= 95p in whole numbers
                    continue
                tags, none, ids, labels, whole = _unpacked(row, dims)
                norms = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
                c = _exact(whole)
                for label, places, tree in state["trees"]:
                    a, b = np.searchsorted(labels, label), np.searchsorted(labels, label, "right")
                    some = np.concatenate([np.arange(a), np.arange(b, len(labels))]) if negatives else np.arange(a, b)
                    if len(some):
                        _visit(state, places, tree, c, norms, some, tags, none, ids, negatives)
        if state is not None:
            yield give()

    names = ["block", "kind", *PACKED, *["asked"] * negatives]
    return pairs.select(*names).mapInArrow(run, "anchor bigint, window int, score bigint, id bigint, tag bigint")


def _visit(state, places, tree, c, norms, some, tags, none, ids, negatives) -> None:
    best, x = state["best"], state["x"][places]
    if x.dtype != c.dtype:
        x, c = x.astype(np.int64), c.astype(np.int64)
    if negatives:
        low, high = state["low"][places], state["high"][places]
        real = low <= high  # no score fits the window of a negative positive, nor of one that is missing
        raised = np.array([[max(l, b.least()) for l, b in zip(r, best[p])] for r, p in zip(low.tolist(), places.tolist())])
        least = np.where(real, raised, np.inf).min(axis=1)
        most = np.where(real, high, -np.inf).max(axis=1)
    else:
        least, most = np.array([best[p][0].least() for p in places.tolist()]), np.full(len(places), np.inf)
    for v, need, scores in window_scores(x, tree, c[some], norms[some], least, most):
        if not len(need):
            continue
        p, at = int(places[v]), some[need]
        if not negatives:
            other = tags[at] != state["tags"][p]
            best[p][0].add(scores[other], none[at][other], ids[at][other], tags[at][other])
            continue
        for j, b in enumerate(best[p]):
            if real[v, j]:
                fits = (scores >= max(low[v, j], b.least())) & (scores <= high[v, j])
                if fits.any():
                    b.add(scores[fits], none[at][fits], ids[at][fits], tags[at][fits])


def mine_hard_negatives(df: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, id_col: str = "vec_id", vec_col: str = "embedding",
                        label_col: str = "label", chunk_rows: int = 8192, block_rows: int = 8192) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of floor(256 * component). An anchor's positives are the first ``positives`` other
    rows of its label by score, then by smaller identifier (null last); a positive's negatives are the first
    ``negatives`` rows of other labels with 50 * positive_score <= 100 * negative_score <= 95 * positive_score.
    ``is_anchor`` is a condition on the identifier column; a null one is no anchor. Rows with a null label or
    vector, null or non-finite components, components of 2**14 or more, or another length than most take no
    part. Rows that share an identifier are different rows: each is anchor, positive and negative of its own.
    A positive without negatives, an anchor alone in its label and an empty table give no rows. Other columns
    are not read.
    """
    spark = df.sparkSession
    dims = dimension_of(df, vec_col)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchor = F.coalesce(is_anchor(F.col(id_col)), F.lit(False)).alias("is_anchor")
    rows = cut_lineage(df.where(F.col(label_col).isNotNull() & F.col(vec_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("tag"), F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.col(vec_col).alias("vec"), anchor))
    blocks = max(1, -(-rows.where("is_anchor").count() // block_rows))
    # Anchors of one label lie in the same blocks as far as blocks reach, so that trees have many of them.
    dealt = rows.where("is_anchor").repartitionByRange(blocks, "label", "tag")
    packed = cut_lineage(_packed(dealt, dims, block_rows))
    numbers = packed.select("chunk", (F.row_number().over(Window.orderBy("chunk")) - 1).alias("block"))  # one short row a block
    packed = packed.join(numbers, "chunk")
    blocks = packed.count()
    if not blocks:
        return _named(rows.select("id", "id", F.lit(0).cast("int"), "id", "id", "id").limit(0))
    chunks = cut_lineage(_packed(rows, dims, chunk_rows))
    found = cut_lineage(topk_per_group(_search(_pairs(chunks, packed, blocks, spread), dims, positives, 1, False), ["anchor"],
                                       [F.desc("score"), F.col("id").asc_nulls_last(), F.col("tag")], positives, "place"))
    asked = cut_lineage(_with_positives(packed, found, positives))
    mined = topk_per_group(_search(_pairs(chunks, asked, blocks, spread), dims, negatives, positives, True), ["anchor", "window"],
                           [F.desc("score"), F.col("id").asc_nulls_last(), F.col("tag")], negatives, "rank")
    known = found.select("anchor", (F.col("place") - 1).cast("int").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = rows.where("is_anchor").select(F.col("tag").alias("anchor"), F.col("id").alias("anchor_id"))
    out = mined.join(known, ["anchor", "window"]).join(ids, "anchor")
    return _named(out.select("anchor_id", "positive_id", F.col("rank").cast("int"), "id", "positive_score", "score"))


def _named(df: DataFrame) -> DataFrame:
    return df.toDF("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _with_positives(packed: DataFrame, found: DataFrame, positives: int) -> DataFrame:
    """Blocks with their anchors' positive scores, in the anchors' order; where one is missing, -1: no score fits."""
    listed = packed.select("block", F.col("tags")).mapInArrow(_listed, "block int, anchor bigint, place int")
    scores = listed.join(found.select("anchor", F.col("place").alias("at"), "score"), "anchor")

    def run(key, rows):
        block = rows.column("block")[0].as_py()
        out = np.full((int(rows.column("size")[0].as_py()), positives), -1, dtype="<i8")
        at = rows.column("at").to_numpy()
        have = at > 0
        out[rows.column("place").to_numpy()[have], at[have] - 1] = rows.column("score").to_numpy()[have]
        return pa.table({"block": pa.array([block], pa.int32()), "asked": pa.array([out.tobytes()], pa.binary())})

    some = scores.select("block", "place", F.col("at").cast("int").alias("at"), "score")
    none = packed.select("block", F.lit(0).alias("place"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("score"))
    every = some.unionAll(none).join(packed.select("block", "size"), "block")
    asked = every.groupBy("block").applyInArrow(run, "block int, asked binary")
    return packed.join(asked, "block")


def _listed(batches):
    for batch in batches:
        for block, tags in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tags = np.frombuffer(tags, dtype="<i8")
            yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(tags), block, dtype=np.int32)), "anchor": pa.array(tags),
                                              "place": pa.array(np.arange(len(tags), dtype=np.int32))})
