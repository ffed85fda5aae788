"""Benchmark decontamination by spaced-seed hashes.

A mask looks at some positions of a run of words and ignores the others. For every item length a fixed family of
masks is complete: however the allowed number of words is substituted in a window, one of its masks fits
somewhere in the window with only unchanged words under it. Mask hashes of the benchmark items are joined with
those of the documents; around each common hash the two texts are laid side by side and their equal words
counted, so that substitutions are tolerated everywhere but under the mask that hit.

Both sides of the join are tables. A Bloom filter of the benchmark's hashes, sized by their number up to a fixed
limit, spares the documents' hashes that have no partner; a full filter costs work, never results.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.ranking import BROADCAST_ROWS
from quarry.llm.common import bloom_bits, bloom_words, give_back, in_bloom, text_slices
from quarry.session import cut_lineage, stored

WORD = re.compile(r"\w+")

# Fixed values, found by a greedy search over masks of up to 12 words and proven by enumeration in the tests:
# (words of the window, substituted words) and the masks of which one always fits (1: looked at, 0: ignored).
# They serve all longer windows with as many substitutions, too.
MASKS = {
    (5, 1): ("1101", "1011"),
    (10, 2): ("11101", "110011"),
    (15, 3): ("111011", "101111"),
    (20, 4): ("1111011", "1110100011", "1110111"),
}
FILTER_BITS = 29  # of the Bloom filter, as a power of two: 64 MB at most
SLICE = 1_500_000  # bytes of text hashed at once: a worker holds some 20 times as much meanwhile


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def least_equal(width: int, share: float) -> int:
    """The least number of equal words of ``width`` that is a share of ``share`` or more."""
    return max(1, math.ceil(share * width - 1e-9))


def masks_of(width: int, share: float) -> tuple[str, ...]:
    """Masks that find every window of ``width`` words with the allowed substitutions. Where none may be
    substituted, or the limits have no family, it is a plain run: of what must stay between the substitutions."""
    need = least_equal(width, share)
    spare = width - need
    known = [m for (w, s), m in MASKS.items() if s == spare and w <= width]
    return known[-1] if known else ("1" * -(-need // (spare + 1)),)


MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mask_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the words under the mask at every offset; the mask itself is part of it."""
    n = max(0, len(ids) - len(mask) + 1)
    h = np.full(n, xxhash.xxh3_64_intdigest(mask.encode()), dtype=np.uint64)
    for j in (j for j, c in enumerate(mask) if c == "1"):
        h = (h ^ ids[j : j + n]) * MULTIPLIER
        h ^= h >> np.uint64(29)
    return h


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the texts' words, one text after the other (never 0), and the texts' offsets."""
    words, ends = [], [0]
    for t in texts:
        words += words_of(t)
        ends.append(len(words))
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    hashed = np.array([xxhash.xxh3_64_intdigest(w) or 1 for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return hashed[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64), np.array(ends)


def _around(ids: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, reach: int) -> pa.Array:
    """The words from ``reach`` before each place to ``reach`` behind it; 0 outside [low, high)."""
    place = at[:, None] + np.arange(-reach, reach)
    inside = (place >= low[:, None]) & (place < high[:, None])
    got = np.where(inside, ids[np.clip(place, 0, max(0, len(ids) - 1))] if len(ids) else 0, 0).astype("<u8")
    raw = pa.py_buffer(np.ascontiguousarray(got).tobytes())
    return pa.Array.from_buffers(pa.binary(16 * reach), len(at), [None, raw]).cast(pa.binary())


def _seeds(benchmark: DataFrame, window: int, share: float) -> DataFrame:
    """(hash, item, place, size, around) of the items' masks at all places. ``benchmark``: item, text."""
    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, _ = word_hashes([text])
                width = min(window, len(ids))
                for mask in masks_of(width, share) if width else ():
                    h = mask_hashes(ids, mask)
                    at, n = np.arange(len(h)), np.full(len(h), len(ids))
                    yield pa.RecordBatch.from_pydict({
                        "hash": pa.array(h.view(np.int64)), "item": pa.array([item] * len(h), pa.string()), "place": pa.array(at), "size": pa.array(n),
                        "around": _around(ids, np.zeros(len(h), int), n, at, window)})

    return benchmark.mapInArrow(run, "hash bigint, item string, place bigint, size bigint, around binary")


def _hits(texts: DataFrame, masks: list[str], words, window: int) -> DataFrame:
    """(hash, digest, place, around) of the documents' masks that the filter lets through. ``texts``: digest, text."""
    def run(batches):
        known = words.value
        for batch in batches:
            for first, some in text_slices(batch.column(1), SLICE):
                ids, ends = word_hashes(some.to_pylist())
                doc = np.repeat(np.arange(len(some)), np.diff(ends))
                low, high = ends[:-1][doc], ends[1:][doc]
                digest = batch.column(0).slice(first, len(some))
                for mask in masks:
                    h = mask_hashes(ids, mask).view(np.int64)
                    at = np.flatnonzero(in_bloom(known, h))
                    at = at[at + len(mask) <= high[at]]
                    if len(at):
                        yield pa.RecordBatch.from_pydict({
                            "hash": pa.array(h[at]), "digest": digest.take(pa.array(doc[at])), "place": pa.array(at - low[at]),
                            "around": _around(ids, low[at], high[at], at, window)})
            give_back()

    return texts.mapInArrow(run, "hash bigint, digest string, place bigint, around binary")


def _lanes(texts: DataFrame, benchmark: DataFrame, window: int, share: float) -> DataFrame:
    """(digest, item, shift): texts and items that have a window of enough equal words when the text's first
    word lies at the item's place ``shift``; each once."""
    spark = texts.sparkSession
    seeds = cut_lineage(_seeds(benchmark, window, share))
    sizes = [r["size"] for r in seeds.select(F.least("size", F.lit(window)).alias("size")).distinct().collect()]  # at most ``window``
    masks = sorted({m for w in sizes for m in masks_of(int(w), share)})
    n = seeds.select("hash").distinct().count()
    words = spark.sparkContext.broadcast(bloom_words(seeds.select("hash").distinct(), "hash", bloom_bits(n, FILTER_BITS)))

    def check(batches):
        for batch in batches:
            d, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), dtype="<u8").reshape(-1, 2 * window) for k in (4, 5))
            width = np.minimum(window, batch.column(3).to_numpy())
            both, equal = (d != 0) & (b != 0), (d == b) & (d != 0)
            good = np.zeros(len(d), dtype=bool)
            for w in np.unique(width).tolist():
                rows = np.flatnonzero(width == w)
                total = lambda x: np.pad(np.cumsum(x[rows], axis=1, dtype=np.int32), ((0, 0), (1, 0)))
                inside, same = total(both), total(equal)
                fits = (inside[:, w:] - inside[:, :-w] == w) & (same[:, w:] - same[:, :-w] >= least_equal(w, share))
                good[rows] = fits.any(axis=1)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep), batch.column(2).filter(keep)],
                                             names=["digest", "item", "shift"])

    # Stored before they are joined, so that no task has two Python workers at once: workers live on, and their memory with them.
    hits = stored(_hits(texts, masks, words, window)).join(seeds.withColumnsRenamed({"place": "at", "around": "theirs"}), "hash")
    found = hits.select("digest", "item", (F.col("at") - F.col("place")).alias("shift"), "size", "around", "theirs").mapInArrow(
        check, "digest string, item string, shift bigint")
    return cut_lineage(found.distinct())


def _small(df: DataFrame) -> DataFrame:
    """Broadcast only up to a counted number of rows; beyond it the join shuffles."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _whole_lane(words: list[str], item: list[str], shift: int, width: int, need: int) -> tuple[int, int, int]:
    """Equal words of text and item along one alignment, from the first to the last window that has enough of
    them: (equal words, first word, end)."""
    a, b = max(0, -shift), min(len(words), len(item) - shift)
    sums = np.concatenate([[0], np.cumsum([x == y for x, y in zip(words[a:b], item[a + shift : b + shift])], dtype=np.int64)])
    good = np.flatnonzero(sums[width:] - sums[:-width] >= need)
    if not len(good):  # two words of one hash
        return 0, 0, 0
    first, last = a + int(good[0]), a + int(good[-1]) + width
    return int(sums[last - a] - sums[first - a]), first, last


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item (a name of the row's identifier and text), item_id and text of the benchmark's rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return benchmark.select(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), text)).alias("item"),
                            F.col(id_col).alias("item_id"), text.alias("text"))


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, share: float = 0.8, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs (id_col, item_col, n_equal, first_word, end_word): documents that hold a run of ``window`` words
    (the whole item if that is shorter) of an item with at least ``share`` of them unchanged, and how many
    words are equal there: of the alignment with most equal words, the first in the text of several.

    Words are \\w+, lower-cased. Items of any length count, under 1 / (1 - share) words as verbatim copies
    only; null and empty ones and texts match nothing. Repeated rows give repeated pairs; other columns are not read.
    """
    kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField(item_col, item_kind), T.StructField("n_equal", T.LongType()),
                           T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("digest", F.md5("text"))
    items = _items(benchmark, item_col, item_text_col)
    lanes = _lanes(plain.select("digest", "text"), items.select("item", "text").distinct(), window, share)
    pairs = cut_lineage(lanes.groupBy("digest", "item").agg(F.sort_array(F.collect_set("shift")).alias("shifts")))

    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def score(batches):
        for batch in batches:
            rows = []
            for i, text, item_id, item, shifts in zip(*(batch.column(k).to_pylist() for k in range(5))):
                words, theirs = words_of(text), words_of(item)
                width = min(window, len(theirs))
                found = [_whole_lane(words, theirs, s, width, least_equal(width, share)) for s in shifts]
                n, first, end = max(found, key=lambda f: (f[0], -f[1]))
                if n:
                    rows.append((i, item_id, n, first, end))
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    rows = plain.join(_small(pairs), "digest").join(items.withColumnRenamed("text", "item_text"), "item")
    return rows.select("id", "text", "item_id", "item_text", "shifts").mapInArrow(score, schema)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 20, share: float = 0.8, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose own text matches no item as in ``contaminated``; identifiers play no part."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    items = _items(benchmark, item_col, item_text_col).select("item", "text").distinct()
    lanes = _lanes(docs.select(F.md5(text).alias("digest"), text.alias("text")), items, window, share)
    gone = cut_lineage(lanes.select(F.col("digest").alias("__digest")).distinct())
    return docs.join(_small(gone), F.md5(text) == F.col("__digest"), "left_anti")
