"""Sums over resamples of a table (H20), for metrics that are a function of such sums.

Poisson weights: the weights of all replicates are one vector per row; a task adds up its rows and reports one
row per replicate. Draws with replacement: a task draws a piece of one replicate, sorts the drawn positions and
sends them as gaps, compressed, to the block of rows they fall in (a quarter of a byte a draw when the piece is as
long as the table); a block's task looks its rows' values up. Neither moves a row per draw."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.md5 import AT_ONCE, digits, md5_words, numbered_hashes
from quarry.functions.ranking import global_rank

BLOCK = 1 << 16  # rows whose values a task holds at once
DRAWS = 1 << 24  # draws a task sorts at once
ROWS = 1 << 14  # rows whose weights a task holds at once


# ------------------------------------------------------------------ Poisson weights
def _row_words(keys: list[bytes], blocks: range):
    """(rows, four uint32 vectors of a row per key and a column per block) of md5(key:block); keys of one length."""
    matrix = np.frombuffer(b"".join(keys), np.uint8).reshape(len(keys), -1)
    k = len(str(blocks[0]))
    step = max(1, AT_ONCE // len(blocks))
    ends = np.concatenate([np.full((len(blocks), 1), ord(":"), np.uint8), digits(blocks.start, blocks.stop, k)], axis=1)
    for a in range(0, len(keys), step):
        some = matrix[a : a + step]
        varying = np.concatenate([np.repeat(some, len(blocks), axis=0), np.tile(ends, (len(some), 1))], axis=1)
        yield slice(a, a + len(some)), [x.reshape(len(some), -1) for x in md5_words(b"", varying)]


def poisson_weights(keys: list[bytes], n_boot: int, cdf) -> np.ndarray:
    """Weights of a row per key and a column per replicate: the cutoffs of ``cdf`` up to the j-th 32-bit number of
    md5(key:block), replicate 4 * block + j."""
    blocks = -(-n_boot // 4)
    cuts = [x for x in (math.ceil(c * 2**32) for c in cdf) if x < 2**32]
    out = np.zeros((len(keys), blocks, 4), np.uint8)
    sizes = np.array([len(k) for k in keys])
    decades = [range(10**k if k else 0, min(blocks, 10 ** (k + 1))) for k in range(len(str(max(blocks - 1, 0))))]
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        same = [keys[i] for i in rows.tolist()]
        for blk in decades:
            for part, words in _row_words(same, blk):
                for j, u in enumerate(words):
                    w = np.zeros(u.shape, np.uint8)
                    for x in cuts:
                        w += u >= np.uint32(x)
                    out[rows[part], blk.start : blk.stop, j] = w
    return out.reshape(len(keys), 4 * blocks)[:, :n_boot]


def poisson_sums(df: DataFrame, values: dict, n_boot: int, cdf) -> DataFrame:
    """(rep, one double per value): per replicate the sums of weight * value over the rows whose value is not null
    (null without any). ``df`` has ``key`` (binary) and ``values`` (name to column)."""
    names = list(values)

    def run(batches):
        total, seen = np.zeros((len(names), n_boot)), np.zeros(len(names), dtype=bool)
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                some = batch.slice(a, ROWS)
                w = poisson_weights(some.column(0).to_pylist(), n_boot, cdf).astype(float)
                known = np.stack([c.is_valid().to_numpy(zero_copy_only=False) for c in some.columns[1:]])
                x = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in some.columns[1:]])
                total += x @ w
                seen |= known.any(axis=1)
        if seen.any():
            yield pa.RecordBatch.from_pydict({"rep": pa.array(range(n_boot), pa.int32())} | {
                n: pa.array(total[i] if seen[i] else [None] * n_boot, pa.float64()) for i, n in enumerate(names)})

    parts = df.select("key", *[v.cast("double").alias(n) for n, v in values.items()]).mapInArrow(
        run, "rep int, " + ", ".join(f"{n} double" for n in names))
    return parts.groupBy("rep").agg(*[F.sum(n).alias(n) for n in names])


# ------------------------------------------------------------------ draws with replacement
def packed_gaps(places: np.ndarray) -> tuple[bytes, int]:
    """Sorted places of a block (0..BLOCK-1) as compressed gaps, and the bytes a gap takes."""
    gaps = np.diff(places, prepend=0)
    gaps = gaps.astype(np.uint8 if gaps.max() < 256 else np.uint16)
    return pa.compress(gaps.tobytes(), codec="zstd", asbytes=True), gaps.itemsize


def places_of(raw: bytes, n: int, size: int) -> np.ndarray:
    gaps = np.frombuffer(pa.decompress(raw, decompressed_size=n * size, codec="zstd", asbytes=True), f"<u{size}")
    return np.cumsum(gaps, dtype=np.int64)


def _draws(spark, head: bytes, n: int, n_boot: int) -> DataFrame:
    """(block, rep, n, size, a): draw d of 0..n_boot*n-1 belongs to replicate d div n and takes the row at place
    hash(head + d) mod n; the draws of a piece of a replicate that fall in one block travel as one row."""
    pieces = -(-n // DRAWS)
    tasks = n_boot * pieces
    slices = min(tasks, max(4 * spark.sparkContext.defaultParallelism, n_boot * n // DRAWS))

    def run(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                rep, piece = divmod(task, pieces)
                first, last = rep * n + n * piece // pieces, rep * n + n * (piece + 1) // pieces
                place, at = np.empty(last - first, np.int64), 0
                for h in numbered_hashes(head, first, last):
                    place[at : at + len(h)] = h % np.uint64(n)
                    at += len(h)
                place.sort()
                blocks = np.arange(place[0] // BLOCK, place[-1] // BLOCK + 2)
                cuts = np.searchsorted(place, blocks * BLOCK)
                rows = [(b, *packed_gaps(place[i:j] - b * BLOCK), j - i) for b, i, j in zip(blocks.tolist(), cuts[:-1].tolist(), cuts[1:].tolist()) if j > i]
                for a in range(0, len(rows), 512):
                    block, raw, size, count = zip(*rows[a : a + 512])
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(block, pa.int64()), "rep": pa.array([rep] * len(block), pa.int32()), "n": pa.array(count, pa.int32()),
                        "size": pa.array(size, pa.int32()), "a": pa.array(raw, pa.binary()), "x": pa.nulls(len(block), pa.binary()), "y": pa.nulls(len(block), pa.binary())})

    return spark.range(0, tasks, 1, slices).mapInArrow(run, _SCHEMA)


_SCHEMA = "block bigint, rep int, n int, size int, a binary, x binary, y binary"


def _row_blocks(ranked: DataFrame) -> DataFrame:
    """The rows (_idx, x, y) of a block that are in one batch as one row: places, values, null where unknown."""
    def run(batches):
        for batch in batches:
            idx = batch.column(0).to_numpy()
            order = np.argsort(idx, kind="stable")
            block = idx[order] // BLOCK
            starts = np.flatnonzero(np.diff(block, prepend=-1)).tolist() if len(idx) else []
            x, y = (c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            known = [c.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8) for c in batch.columns[1:]]
            rows = {k: [] for k in ("block", "rep", "n", "size", "a", "x", "y")}
            for i, j in zip(starts, [*starts[1:], len(idx)]):
                o = order[i:j]
                values = (int(block[i]), -1, j - i, 0, (idx[o] - block[i] * BLOCK).astype("<u2").tobytes(),
                          x[o].astype("<f8").tobytes() + known[0][o].tobytes(), y[o].astype("<f8").tobytes() + known[1][o].tobytes())
                for k, v in zip(rows, values):
                    rows[k].append(v)
            yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, v), t in zip(rows.items(), (
                pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))})

    return ranked.select("_idx", "x", "y").mapInArrow(run, _SCHEMA)


def draw_sums(df: DataFrame, order_col: str, n: int, n_boot: int, seed, spread_of_y: bool = False) -> DataFrame:
    """(rep, n, nx, sx, ny, sy, sy2, low, high): over the n rows that a replicate draws, their number, and number and sum
    of the not-null ``x``; with ``spread_of_y`` number, sum, sum of squares, least and greatest of ``y`` as well.
    Rows are numbered by ``order_col``."""
    spark = df.sparkSession
    ranked = global_rank(df.select(order_col, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), [order_col], "_idx")
    both = _row_blocks(ranked).unionByName(_draws(spark, f"{seed}:".encode(), n, n_boot))

    def run(batches):
        sums, low, high = np.zeros((6, n_boot)), np.full(n_boot, np.inf), np.full(n_boot, -np.inf)
        now, values = None, None
        for batch in batches:
            block, rep, count, size, a, x, y = (batch.column(i) for i in range(7))
            for i, (b, r, m, s) in enumerate(zip(block.to_pylist(), rep.to_pylist(), count.to_pylist(), size.to_pylist())):
                if b != now:
                    now, values = b, np.zeros((4, BLOCK))
                if r < 0:  # rows come before draws
                    at = np.frombuffer(a[i].as_py(), "<u2")
                    for k, c in enumerate((x, y)):
                        raw = c[i].as_py()
                        values[2 * k, at], values[2 * k + 1, at] = np.frombuffer(raw, "<f8", m), np.frombuffer(raw, np.uint8, m, 8 * m)
                    continue
                at = places_of(a[i].as_py(), m, s)
                sums[0, r] += m
                sums[1, r] += values[1][at].sum()
                sums[2, r] += values[0][at].sum()
                if spread_of_y:
                    got = values[2][at][values[3][at] > 0]
                    if len(got):
                        sums[3, r] += len(got)
                        sums[4, r] += got.sum()
                        sums[5, r] += (got * got).sum()
                        low[r], high[r] = np.minimum(low[r], got.min()), np.maximum(high[r], got.max())
        some = np.flatnonzero(sums[0])
        if len(some):
            yield pa.RecordBatch.from_pydict({"rep": pa.array(some.astype(np.int32))} | {
                k: pa.array(v[some]) for k, v in zip(("n", "nx", "sx", "ny", "sy", "sy2", "low", "high"), (*sums, low, high))})

    names = ("n", "nx", "sx", "ny", "sy", "sy2")
    parts = both.repartition("block").sortWithinPartitions("block", "rep").mapInArrow(
        run, "rep int, " + ", ".join(f"{k} double" for k in (*names, "low", "high")))
    return parts.groupBy("rep").agg(*[F.sum(k).alias(k) for k in names], F.min("low").alias("low"), F.max("high").alias("high"))
