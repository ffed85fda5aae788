"""BPE encoding and decoding from a public vocabulary file.

Pre-tokens are encoded by merging a doubly linked symbol list: a heap holds (rank, position) of every
mergeable neighbour pair; an entry whose pair has changed meanwhile is stale and is skipped. Decoding
concatenates vocabulary strings. Merges never cross a pre-token, so each worker keeps a bounded cache of
pre-tokens and of blank-separated chunks; whole texts are then looked up chunk by chunk.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import unicodedata

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ChunkMemo, blank_chunks, give_back, join_chunks, text_slices

CACHE_ENTRIES = 100_000
SLICE = 2_500_000  # bytes of text encoded at once
ODD_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split(), not to Unicode


def byte_symbols() -> list[str]:
    """The printable character for each byte: printable Latin-1 bytes are themselves, the others follow
    from code point 256 on, in byte order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


# Where the vocabulary's own library (letters of Unicode 16, lower case of Unicode 17) and
# this Python (regex module: later letters; str.lower: Unicode 15.1) differ, found by a sweep of all code points.
LATER_LETTERS = (
    "\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
    "\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
)
LATER_NUMBERS = "\U00011de0-\U00011de9\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ff4-\U00016ff6"
LATER_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B,
               **{c: c + 0x20 for c in range(0x10D50, 0x10D66)}, **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}
# Combining marks (and the second half of one composition) that the library's older normaliser takes for letters
# of their own: nothing is reordered or composed across them.
LATER_MARKS = re.compile(
    "([\u07fd\u0898-\u089f\u08ca-\u08d3\u09fe\u0c3c\u0d3b-\u0d3c\u0eba\u1715\u1abf-\u1ace\u1df6-\u1dfa\ua82c\U00010d24-\U00010d27"
    "\U00010eab-\U00010eac\U00010efd-\U00010eff\U00010f46-\U00010f50\U00010f82-\U00010f85\U00011070\U0001133b\U0001145e"
    "\U00011839-\U0001183a\U00011930\U0001193d-\U0001193e\U00011943\U000119e0\U00011a34\U00011a47\U00011a99\U00011d42"
    "\U00011d44-\U00011d45\U00011d97\U00011f41-\U00011f42\U00016ff0-\U00016ff1\U0001e08f\U0001e130-\U0001e136\U0001e2ae"
    "\U0001e2ec-\U0001e2ef\U0001e4ec-\U0001e4ef])")
NEEDS_LOWER = re.compile("[" + "".join(map(chr, LATER_LOWER)) + "]")


def _known(pattern: str) -> str:
    """The pattern with the letters that the vocabulary's own library knows."""
    letters, numbers = f"[{LATER_LETTERS}]", f"[{LATER_NUMBERS}]"
    return (pattern.replace("[^\\s\\p{L}\\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||{letters}||{numbers}]")
            .replace("[\\p{L}]", f"[\\p{{L}}--{letters}]").replace("[\\p{N}]", f"[\\p{{N}}--{numbers}]"))


class WordBpe:
    """Encoder and decoder of a word-end BPE file (JSON): special strings are cut out first, the rest is
    normalised (NFC, white space, lower case), split into pre-tokens and merged by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in special.items()}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        ids = self.vocab
        self.size = 1 + max(ids.values())
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self.rank_of = {ids[a] * self.size + ids[b]: rank for rank, (a, b) in enumerate(pairs)}.get
        self.made = [ids[a + b] for a, b in pairs]
        self.inner, self.last = [ids[c] for c in byte_symbols()], [ids[c + self.end] for c in byte_symbols()]
        self.pieces = regex.compile(_known(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]), regex.V1)
        self.words = ChunkMemo(lambda words: map(self.merge, words), CACHE_ENTRIES)
        self.chunks = ChunkMemo(self._chunks, CACHE_ENTRIES)

    def merge(self, word: str) -> tuple[int, ...]:
        """Ids of one pre-token. Heap entries are rank * length + position; an entry is stale if the pair
        that now starts at its position has another rank or none."""
        raw = word.encode()
        ids = [*map(self.inner.__getitem__, raw[:-1]), self.last[raw[-1]], -1]
        n, rank_of, made, size = len(ids) - 1, self.rank_of, self.made, self.size
        heap = [r * n + i for i in range(n - 1) if (r := rank_of(ids[i] * size + ids[i + 1])) is not None]
        if not heap:
            return tuple(ids[:n])
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heapq.heapify(heap)
        while heap:
            r, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            if j == n or ids[i] < 0 or rank_of(ids[i] * size + ids[j]) != r:
                continue
            new = ids[i] = made[r]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(new * size + ids[k])) is not None:
                    heapq.heappush(heap, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank_of(ids[h] * size + new)) is not None:
                heapq.heappush(heap, r * n + h)
        return tuple([x for x in ids if x >= 0])

    def _chunks(self, chunks: list[str]) -> list[tuple[bytes, str]]:
        """Of texts without white space: ids as little-endian unsigned 32-bit integers, and their strings."""
        split = []
        for chunk in chunks:
            word = chunk.rstrip(".,")
            if word.isalpha():
                split.append((word, chunk[len(word):]) if len(word) < len(chunk) else (word,))
            else:
                split.append(self.pieces.findall(chunk))
        ids_of = self.words.values({w for words in split for w in words})
        out = []
        for words in split:
            ids = [i for w in words for i in ids_of[w]]
            out.append((struct.pack(f"<{len(ids)}I", *ids), " ".join(map(self.strings.__getitem__, ids))))
        return out

    def _normalised(self, text: str) -> str:
        """Chunks without white space, between single blanks."""
        if not text.isascii():
            text = "".join([unicodedata.normalize("NFC", part) for part in LATER_MARKS.split(text)])
            if NEEDS_LOWER.search(text):
                text = text.translate(LATER_LOWER)
            text = text.replace("Σ", "σ")  # lower case goes by single characters: no final sigma
        text = text.lower()
        if ODD_SPACE.search(text):
            return " ".join([w for w in regex.split(r"\p{White_Space}+", text) if w])
        return " ".join(text.split())

    def encode_texts(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """(ids as little-endian unsigned 32-bit integers, decoded texts) of whole texts."""
        plain = pa.array([self._normalised(t) for t in texts], pa.large_string())
        offsets, numbers, chunks = blank_chunks(plain)
        chunks = chunks.to_pylist()
        known = self.chunks.values(chunks)
        ids = join_chunks(pa.array([known[c][0] for c in chunks], pa.large_binary()), numbers, offsets, pa.scalar(b"", pa.large_binary()))
        said = join_chunks(pa.array([known[c][1] for c in chunks], pa.large_string()), numbers, offsets, pa.scalar(" ", pa.large_string()))
        special = [k for k, t in enumerate(texts) if "<|" in t and self.cut and self.cut.search(t)]
        if special:
            ids, said = ids.to_pylist(), said.to_pylist()
            for k in special:
                ids[k], said[k] = self._with_special(texts[k])
            ids, said = pa.array(ids, pa.large_binary()), pa.array(said, pa.large_string())
        return ids, said

    def _with_special(self, text: str) -> tuple[bytes, str]:
        found = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                found.append((struct.pack("<I", self.special[part]), part))
            elif part:
                found.append(self.encode_bytes(part))
        return b"".join([a for a, _ in found]), " ".join([b for a, b in found if a])

    def encode_bytes(self, text: str) -> tuple[bytes, str]:
        ids, said = self.encode_texts([text])
        return ids[0].as_py(), said[0].as_py()

    def encode(self, text: str) -> list[int]:
        return [x for (x,) in struct.iter_unpack("<I", self.encode_bytes(text)[0])]

    def decode(self, ids) -> str:
        """The ids' vocabulary strings, joined by blanks (the file names no decoder); unknown ids are dropped."""
        return " ".join(self.strings[i] for i in ids if i in self.strings)


_LOADED: dict[str, WordBpe] = {}


def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def bpe_tokens(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text",
               with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: id_col, n_tokens, ids_sha256, decoded_sha256 and, if
    ``with_ids``, ids (array of int) and decoded.

    Null and empty texts have no tokens and an empty decoded text. Rows stay as they are (repeats too);
    other columns are not read. ``vocabulary``: a file of public_tokenizers, on every machine.
    """
    def run(batches):
        bpe = word_bpe(public_tokenizers.path(vocabulary))
        try:
            for batch in batches:
                for at, texts in text_slices(batch.column(1).fill_null(""), SLICE):
                    raw, decoded = bpe.encode_texts(texts.to_pylist())
                    raw, decoded = raw.cast(pa.binary()), decoded.cast(pa.string())
                    ends = np.frombuffer(raw.buffers()[1], "<i4", count=len(raw) + 1)
                    out = {id_col: batch.column(0).slice(at, len(texts)), "n_tokens": pa.array(np.diff(ends).astype(np.int64) // 4),
                           "ids_sha256": pa.array([hashlib.sha256(r.as_buffer()).hexdigest() for r in raw], pa.string()),
                           "decoded_sha256": pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in decoded], pa.string())}
                    if with_ids:
                        ids = np.frombuffer(raw.buffers()[2], "<i4") if raw.buffers()[2] is not None and ends[-1] else np.zeros(0, "<i4")
                        out |= {"ids": pa.ListArray.from_arrays(pa.array(ends // 4), pa.array(ids[: ends[-1] // 4])), "decoded": decoded}
                    yield pa.RecordBatch.from_pydict(out)
                give_back()
        finally:  # the worker process goes on; its memo does not
            bpe.words.clear()
            bpe.chunks.clear()
            give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema + ", ids array<int>, decoded string" * with_ids)
