"""Small helpers the operators share: reading tables, Arrow batches, bounded caches, samples."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the word rules: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the application's Python workers, once, as Spark ships any Python file: the
    tasks' functions are modules of it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="quarry-"), "quarry.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def row_fraction(*cols) -> F.Column:
    """A fixed number in [0, 1) per row, from a hash of the columns (same on every run and retry)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / F.lit(float(1 << 40))


#: At most so many keys of a join are broadcast.
HOT_KEYS = 10_000


def join_hot(big: DataFrame, small: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``big`` with ``small``, which has one row a key and in ``weight`` how many rows of ``big`` have it. Keys with more
    than a ten-thousandth of big's rows (so at most HOT_KEYS of them) are broadcast, all others shuffled."""
    heavy = F.col(weight) > big.count() // HOT_KEYS
    few = small.where(heavy)
    light = big.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(small.where(~heavy), keys)
    return big.join(F.broadcast(few), keys).unionByName(light)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null counts as the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]


def text_slices(texts: pa.Array, size: int = 6_000_000):
    """Slices of about ``size`` bytes, at least one text each: bounds what a task holds at once."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield at, texts.slice(at, end - at)
        at = end


def blank_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Texts cut at every single blank, each distinct chunk once: the texts' offsets into the second, which
    has the chunks' numbers, and the chunks. An empty text is one empty chunk."""
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    return offsets - offsets[0], coded.indices.to_numpy(), coded.dictionary


def join_chunks(values: pa.Array, numbers: np.ndarray, offsets: np.ndarray, between) -> pa.Array:
    """Each text's chunk values, one after the other."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values.take(pa.array(numbers))), between)


class ChunkMemo:
    """Bounded memo of a worker, filled many keys at a time. ``make(keys)`` gives the values of a list of
    keys. Past ``size`` entries or ``chars`` characters of keys the young generation becomes the old one and the
    old one goes; what is used again moves back, so at most twice as much (and one batch's) is held."""

    def __init__(self, make, size: int, chars: int = 4_000_000):
        self.make, self.size, self.chars, self.young, self.old, self.held = make, size, chars, {}, {}, 0

    def clear(self) -> None:
        self.young, self.old, self.held = {}, {}, 0

    def values(self, keys) -> dict:
        """A dict that has at least ``keys``."""
        if len(self.young) > self.size or self.held > self.chars:
            self.old, self.young, self.held = self.young, {}, 0
        young, old = self.young, self.old
        missed, before = [], len(young)
        for k in keys:
            if k in young:
                continue
            if k in old:
                young[k] = old[k]
            else:
                missed.append(k)
        if missed:
            young.update(zip(missed, self.make(missed)))
        if len(young) > before:
            self.held += sum(map(len, missed)) + 8 * (len(young) - before - len(missed))
        return young


def give_back() -> None:
    """Return free Arrow and C heap memory to the system: Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def in_parts(items: list, size: int):
    for i in range(0, len(items), size):
        yield items[i : i + size]


def bloom_words(keys: DataFrame, col: str, log2_bits: int) -> np.ndarray:
    """Bloom filter of a long column as 2**log2_bits bits in uint64 words; a key's four bits share a word.
    The words are made and merged on the cluster; the driver gets at most 2**(log2_bits - 6) of them,
    whatever the keys' number."""
    def words(batches):
        for batch in batches:
            word, bits = _word_and_bits(batch.column(0).to_numpy(zero_copy_only=False), log2_bits)
            order = np.argsort(word, kind="stable")
            word, at = np.unique(word[order], return_index=True)
            if len(word):
                yield pa.RecordBatch.from_pydict({"w": pa.array(word), "v": pa.array(np.bitwise_or.reduceat(bits[order], at).view(np.int64))})

    merged = keys.select(col).mapInArrow(words, "w bigint, v bigint").groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()
    out = np.zeros(1 << (log2_bits - 6), dtype=np.uint64)
    if merged.num_rows:
        out[merged.column("w").to_numpy()] = merged.column("v").to_numpy().view(np.uint64)
    return out


def _word_and_bits(keys: np.ndarray, log2_bits: int) -> tuple[np.ndarray, np.ndarray]:
    u = keys.astype(np.int64, copy=False).view(np.uint64)
    word = ((u * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - (log2_bits - 6))).astype(np.int64)
    h, bits = u * np.uint64(0xC2B2AE3D27D4EB4F), np.zeros(len(u), dtype=np.uint64)
    for shift in (58, 52, 46, 40):
        bits |= np.uint64(1) << ((h >> np.uint64(shift)) & np.uint64(63))
    return word, bits


def bloom_bits(n: int, most: int, per_key: int = 16) -> int:
    """Size of a filter for ``n`` keys as a power of two, between 2**12 and 2**most."""
    return min(most, max(12, (per_key * n).bit_length()))


def in_bloom(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64 keys may be in the filter (no false negatives)."""
    word, bits = _word_and_bits(keys, int(words.size).bit_length() - 1 + 6)
    return (words[word] & bits) == bits
