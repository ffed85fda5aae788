"""Token counts by a map-side two-tier lookup.

A compact table of the token counts of frequent pre-tokens is made once and broadcast; what it lacks is
encoded by the library and remembered in a bounded cache of each worker. Pre-tokens are never shuffled.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from quarry.llm.common import ChunkMemo, blank_chunks, in_parts, row_fraction, texts_of

CACHE_ENTRIES = 250_000
WORDS_AT_ONCE = 500
ODD_BLANKS = re.compile("  |^ | $|▁")
PARTS = re.compile("[ ▁]*[^ ▁]+|[ ▁]+")

_LOADED: dict[str, SentencePieceProcessor] = {}


_REST: dict[str, ChunkMemo] = {}


def _rest(path: str) -> ChunkMemo:
    """The worker's memo of pre-tokens that the table lacks; it lives as long as the worker."""
    if path not in _REST:
        sp = _model(path)
        starts = np.array([sp.id_to_piece(i).startswith("\u2581") for i in range(sp.vocab_size())])
        _REST[path] = ChunkMemo(lambda words: _lengths(sp, starts, words), CACHE_ENTRIES)
    return _REST[path]


def _model(path: str) -> SentencePieceProcessor:
    if path not in _LOADED:
        _LOADED[path] = SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def pre_tokens(text: str) -> list[str]:
    """The text's blank-separated pre-tokens, without their single leading blank. The model writes a blank
    as a visible mark, adds one in front of the text, and no piece of its vocabulary has the mark after
    another character, so no piece spans two of these. In texts with runs of blanks, blanks at an end or
    the mark itself, a pre-token starts with its run: the first blank of each is left off."""
    if not text:
        return []
    if not ODD_BLANKS.search(text):
        return text.split(" ")
    return [p[1:] for p in PARTS.findall(" " + text)]


def frequent_pre_tokens(docs: DataFrame, text_col: str = "text", sample: float = 0.02, per_task: int = 20_000,
                        top: int = 50_000) -> list[str]:
    """The table's pre-tokens: each task counts its share of sampled rows and sends its ``per_task`` most
    frequent ones. Only speed depends on them: ``top`` bounds the table, ``sample`` its cost."""
    def run(batches):
        seen = Counter()
        for batch in batches:
            for text in texts_of(batch.column(0)):
                seen.update(pre_tokens(text))
            if len(seen) > 20 * per_task:
                seen = Counter(dict(seen.most_common(5 * per_task)))
        kept = [(t, n) for t, n in seen.most_common(per_task) if n > 2]
        yield pa.RecordBatch.from_pydict({"t": pa.array([t for t, _ in kept], pa.string()), "n": pa.array([n for _, n in kept], pa.int64())})

    share = docs.where(row_fraction(F.col(text_col)) < sample).select(F.col(text_col).alias("text"))
    best = share.mapInArrow(run, "t string, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    return [r.t for r in best.orderBy(F.desc("n"), "t").limit(top).collect()]


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", sample: float = 0.02, top: int = 50_000) -> DataFrame:
    """One row per row: id_col, n_bytes (UTF-8), n_tokens (no added tokens), over_limit (n_tokens > limit).

    Null counts as the empty text, which has no tokens. Repeated rows stay; other columns are not read.
    """
    spark = docs.sparkSession
    words = frequent_pre_tokens(docs, text_col, sample, top=top)
    lengths = _rest(public_tokenizers.path(model)).make(words)
    table = spark.sparkContext.broadcast(dict(zip(words, lengths)))

    def run(batches):
        rest = _rest(public_tokenizers.path(model))
        frequent = table.value
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(1).fill_null("")
            n = count_tokens(texts, frequent, rest)
            yield pa.RecordBatch.from_pydict({id_col: batch.column(0), "n_bytes": pc.binary_length(texts).cast(pa.int64()),
                                              "n_tokens": pa.array(n), "over_limit": pa.array(n > limit)})

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")


def count_tokens(texts: pa.Array, frequent: dict[str, int], rest: ChunkMemo) -> np.ndarray:
    """Token counts of whole texts: the broadcast table first, the worker's memo for what it lacks."""
    offsets, numbers, chunks = blank_chunks(texts)
    chunks = chunks.to_pylist()
    known = rest.values([c for c in chunks if c not in frequent])
    n = np.array([frequent[c] if c in frequent else known[c] for c in chunks], dtype=np.int64)
    out = np.add.reduceat(n[numbers], offsets[:-1])
    odd = np.array([not c or "\u2581" in c for c in chunks])
    for k in np.flatnonzero(np.logical_or.reduceat(odd[numbers], offsets[:-1])).tolist():
        words = pre_tokens(texts[k].as_py())  # runs of blanks: its pre-tokens are not these chunks
        known = rest.values([w for w in words if w not in frequent])
        out[k] = sum(frequent[w] if w in frequent else known[w] for w in words)
    return out


def _lengths(sp: SentencePieceProcessor, starts: np.ndarray, words: list[str]) -> list[int]:
    """Token counts of pre-tokens, each with the blank that it has lost; the empty one is the lone blank.
    Those without further blanks are encoded together: every piece that starts with a blank starts one."""
    plain = [bool(w) and " " not in w and "\u2581" not in w for w in words]
    joined = iter(_joined(sp, starts, [w for w, p in zip(words, plain) if p]))
    return [next(joined) if p else len(sp.encode(w)) if w else 1 for w, p in zip(words, plain)]


def _joined(sp: SentencePieceProcessor, starts: np.ndarray, words: list[str]):
    for some in in_parts(words, WORDS_AT_ONCE):
        ids = np.array(sp.encode(" ".join(some)), dtype=np.int64)
        at = np.flatnonzero(starts[ids])
        if at.size != len(some):  # a piece that the cut does not know
            yield from (len(sp.encode(w)) for w in some)
        else:
            yield from np.diff(np.append(at, ids.size)).tolist()
