"""Token-ID output: Parquet list columns that can be read selectively.

Files hold one row per document in ascending identifier order (part files are in that order too): shard,
doc_id, local_start, n_tokens and ids. Integer columns are delta-encoded, or dictionary-encoded on request;
row groups and pages are kept small, and the writer adds page indexes, so that a filter on doc_id reads few
pages of ids and a query on counts reads none.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.bpe import byte_symbols
from quarry.llm.common import text_slices

#: Texts of these characters alone (ASCII and Latin letters and signs, whose classes no version of Unicode has changed)
#: are cut into pre-tokens alike by the library and by the vocabulary's stated pattern.
ODD = re.compile("[^\t\n\r\x20-\x7e\xa1-\u024f]|<\\|")


def ranked_encoding(path: str) -> tiktoken.Encoding | None:
    """The vocabulary file's merges as ranks of byte strings; None if the order of its identifiers is not that
    of its merges, or if it has another way of cutting texts than the plain byte-level one."""
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, cut = whole["model"], whole.get("pre_tokenizer") or {}
    vocabulary, byte_of = model["vocab"], {c: b for b, c in enumerate(byte_symbols())}
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not whole.get("normalizer")
    if not plain or any(a >= b for a, b in zip(merged, merged[1:])) or not all(c in vocabulary for c in byte_of):
        return None
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocabulary.items() if all(c in byte_of for c in t)}
    return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class TextEncoder:
    """The library's encoding of whole texts. Plain texts (see ODD) are encoded by merge ranks, which give the
    same identifiers several times as fast; all others, and those that may hold a special string, by the library."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.ranked = ranked_encoding(path)

    def ids(self, text: str) -> np.ndarray:
        if self.ranked is None or ODD.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.ranked.encode_to_numpy(text, disallowed_special=())

    def encode_texts(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by ``end_id`` if there is one, and the texts' offsets."""
        end = np.zeros(0, np.uint32) if end_id is None else np.array([end_id], np.uint32)
        parts = [p for t in texts.to_pylist() for p in (self.ids(t), end)]
        size = np.array([len(p) for p in parts], dtype=np.int64).reshape(-1, 2).sum(axis=1)
        return np.concatenate(parts) if parts else end[:0], np.concatenate([[0], np.cumsum(size)])


_LOADED: dict[str, TextEncoder] = {}


def _encoder(path: str) -> TextEncoder:
    if path not in _LOADED:
        _LOADED[path] = TextEncoder(path)
    return _LOADED[path]


def write_token_files(docs: DataFrame, path: str, vocabulary: str = "byte_bpe_50k.json", end_id: int | None = 2,
                      id_col: str = "doc_id", text_col: str = "text", encoding: str = "delta", row_group_mb: int = 16,
                      page_rows: int = 2000, page_kb: int = 256, shards: int | None = None) -> None:
    """Write token files under ``path`` (replaced if there).

    Null and empty texts have only the end id (nothing at all if ``end_id`` is None). Null identifiers come
    first. Rows that share an identifier are ordered by a hash of their texts, so that any number of them is cut
    into ranges; repeated rows lie one behind the other. An empty table writes files without rows.
    ``encoding``: "delta" (delta binary packed) or "dictionary". Texts, not ids, are shuffled: once, by ranges.
    """
    if encoding not in ("delta", "dictionary"):
        raise ValueError("encoding is delta or dictionary")

    def run(batches):
        encoder, start = _encoder(public_tokenizers.path(vocabulary)), 0
        for batch in batches:
            for first, texts in text_slices(batch.column(2)):
                ids, at = encoder.encode_texts(texts, end_id)
                yield pa.RecordBatch.from_pydict({
                    "shard": batch.column(0).slice(first, len(texts)), "doc_id": batch.column(1).slice(first, len(texts)), "local_start": pa.array(start + at[:-1]),
                    "n_tokens": pa.array(np.diff(at)), "ids": pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.view(np.int32)))})
                start += int(at[-1])
                del ids, at
            pa.default_memory_pool().release_unused()

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = plain.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = plain.repartitionByRange(n, "doc_id", "hash", "row").sortWithinPartitions("doc_id", "hash", "row")
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    (
        ordered.mapInArrow(run, f"shard int, doc_id {kind}, local_start bigint, n_tokens bigint, ids array<int>")
        .write.mode("overwrite")
        .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
        .option("parquet.writer.version", "v2")
        .option("parquet.block.size", str(row_group_mb << 20))
        .option("parquet.page.size", str(page_kb << 10))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and, if asked for, ids. The files' totals,
    one row each, are summed from the count columns alone; without ids no id page is read."""
    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_tokens").alias("n")).toArrow().sort_by("shard")  # a row per file
    shards, sums = totals.column("shard").to_pylist(), totals.column("n").to_pylist()
    before = dict(zip(shards, np.concatenate([[0], np.cumsum(np.array(sums, dtype=np.int64))]).tolist()))
    base = spark.createDataFrame(list(before.items()) or [(0, 0)], "shard int, base bigint")
    out = files.join(F.broadcast(base), "shard")
    return out.select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", *["ids"] * with_ids)


def id_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            values, at = np.ascontiguousarray(lists.flatten().to_numpy(zero_copy_only=False), dtype="<i4"), lists.offsets.to_numpy()
            view = memoryview(values).cast("B")
            at = (at - at[0]) * 4
            crc = [zlib.crc32(view[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(crc, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
