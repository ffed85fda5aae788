"""Removal of repeated byte strings by sorted suffixes.

A string of ``length`` bytes that occurs twice has the same smallest gram hash in both places, at the same
offset. Every text is therefore cut, window by window, into fragments that each hold all windows around one
such gram; fragments meet under their gram's hash. Equal fragments are counted once, with their number. Where
different fragments meet, their bytes become symbols (blocks on a grid that is anchored at the gram, numbered in
byte order), their suffixes are sorted in linear time by groups of Lyndon prefixes, and neighbours in that order
that agree on all whole blocks of a window are compared byte by byte for the rest of it.

Suffix order: suffixes are grouped by their first symbol; groups are processed in descending order, each giving
its Lyndon prefix to the suffixes that its members' previous-smaller pointers name, which leave their group for
one of their own behind it. Then every group's order is emitted by one ascending pass along the same pointers.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import give_back, join_hot
from quarry.session import cut_lineage, scratch_path

LENGTH = 400
BLOCK = 16            # bytes of a symbol
GROUP_ROWS = 4000     # different fragments of one gram that a task sorts; more are told apart window by window
SORT_BYTES = 3_000_000  # fragments that a task sorts at once
SLICE = 1 << 20       # bytes hashed at once


def suffix_array(text: list[int]) -> list[int]:
    """Positions in the order of their suffixes. The last symbol must be smaller than all others."""
    symbols = np.asarray(text)
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if n else np.zeros(0, dtype=int)
    start_of = np.repeat(first, np.diff(np.append(first, n)))
    place = np.empty(n, dtype=int)
    place[order] = np.arange(n)
    group, size = start_of[place].tolist(), np.zeros(n, dtype=int)
    size[first] = np.diff(np.append(first, n))
    place, size, members_of, smaller = place.tolist(), size.tolist(), order.tolist(), [-1] * n

    def to_end(p: int) -> int:
        """Move p to the end of its group's members, which become one fewer; the group."""
        g = group[p]
        left = size[g] - 1
        end = g + left
        other, at = members_of[end], place[p]
        members_of[at], place[other] = other, at
        members_of[end], place[p] = p, end
        size[g] = left
        return g

    end = n
    while end:
        g = group[members_of[end - 1]]
        if end - g == 1:
            s = members_of[g]
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            if p >= 0 and size[group[p]] > 1:
                to_end(p)
                group[p] = place[p]
                size[place[p]] = 1
        else:
            named: dict[int, int] = {}
            for s in sorted(members_of[g:end]):
                p = s - 1
                while p >= 0 and group[p] >= g:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    named[p] = named.get(p, 0) + 1
            by_count: dict[int, list[int]] = {}
            for p, c in named.items():
                by_count.setdefault(c, []).append(p)
            for c in sorted(by_count, reverse=True):  # more copies of the prefix: a larger suffix
                moved: dict[int, int] = {}
                for p in by_count[c]:
                    old = to_end(p)
                    moved[old] = moved.get(old, 0) + 1
                new = {old: old + size[old] for old in moved}
                for p in by_count[c]:
                    group[p] = new[group[p]]
                for old, m in moved.items():
                    size[new[old]] = m
        end = g

    out, free, placed = [0] * n, list(range(n)), bytearray(n)
    if n:
        out[0] = n - 1
        placed[n - 1] = 1
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            placed[p] = 1
            g = group[p]
            out[free[g]] = p
            free[g] += 1
            p = smaller[p]
    return out


def repeated_windows(fragments: list[bytes], offsets: list[int], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a window of each fragment that also starts elsewhere in the fragments; -1 if none
    does. ``offsets`` are the grams' places, on which the blocks are aligned."""
    whole = (length - BLOCK + 1) // BLOCK   # blocks that any window holds from its first one on
    rest = length - whole * BLOCK
    sizes = np.array([len(f) for f in fragments])
    buffer = np.frombuffer(b"".join(fragments) + bytes(rest + BLOCK), dtype=np.uint8)
    base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    lead = np.asarray(offsets) % BLOCK
    blocks = np.maximum(sizes - lead, 0) // BLOCK
    owner = np.repeat(np.arange(len(sizes)), blocks)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = (base + lead)[owner] + BLOCK * number
    words = np.ascontiguousarray(buffer[at[:, None] + np.arange(BLOCK)]).view(">u8").reshape(-1, BLOCK // 8)
    order = np.lexsort(words.T[::-1])
    fresh = np.any(words[order][1:] != words[order][:-1], axis=1) if len(order) else np.zeros(0, dtype=bool)
    symbol = np.empty(len(order), dtype=np.int64)
    symbol[order] = np.concatenate([[0], np.cumsum(fresh)])[: len(order)] + 2
    # The fragments' symbols one after the other, a one behind each, a zero at the end.
    spot = np.arange(len(owner)) + owner
    text = np.ones(len(owner) + len(sizes) + 1, dtype=np.int64)
    text[spot], text[-1] = symbol, 0
    block_at = np.full(len(text), -1)
    block_at[spot] = np.arange(len(owner))

    sorted_blocks = block_at[np.array(suffix_array(text), dtype=np.int64)]
    real = sorted_blocks >= 0
    real[real] = number[sorted_blocks[real]] + whole <= blocks[owner[sorted_blocks[real]]]
    here = np.flatnonzero(real[1:] & real[:-1])
    for k in range(whole):
        a, b = sorted_blocks[here], sorted_blocks[here + 1]
        here = here[symbol[a + k] == symbol[b + k]]
    first, last = np.full(len(sizes), np.iinfo(np.int64).max), np.full(len(sizes), -1)
    if len(here):
        new = np.ones(len(here), dtype=bool)
        new[1:] = np.diff(here) > 1
        cluster = np.concatenate([np.cumsum(new), np.cumsum(new)])
        member = np.concatenate([sorted_blocks[here], sorted_blocks[here + 1]])
        member, one = np.unique(member, return_index=True)
        cluster = cluster[one]
        begin, of = at[member], owner[member]
        width = -(-rest // 8) * 8
        for back in range(BLOCK):
            start = begin - base[of] - back
            ok = np.flatnonzero((start >= 0) & (start + length <= sizes[of]))
            if not len(ok):
                continue
            key = np.zeros((len(ok), width), dtype=np.uint8)
            from_here = np.concatenate([np.arange(-back, 0), whole * BLOCK + np.arange(rest - back)])
            key[:, :rest] = buffer[begin[ok][:, None] + from_here]
            key = np.column_stack([cluster[ok].astype(np.uint64), key.view(np.uint64)])
            order = np.lexsort(key.T[::-1])
            same = np.all(key[order][1:] == key[order][:-1], axis=1)
            twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]
            np.minimum.at(first, of[ok][twice], start[ok][twice])
            np.maximum.at(last, of[ok][twice], start[ok][twice])
    return np.where(last < 0, -1, first), last


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
FACTOR = 0x9E3779B97F4A7C15


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        up, down = np.full(SLICE, FACTOR, dtype=np.uint64), np.full(SLICE, pow(FACTOR, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[0] = np.cumprod(up), np.cumprod(down)
    return _POWERS[0]


def _gram_hashes(text: np.ndarray, gram: int) -> np.ndarray:
    """A mixed polynomial hash of the ``gram`` bytes from each place on."""
    up, down = _powers()
    total = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[: len(text)], out=total[1:])
    h = (total[gram:] - total[:-gram]) * down[: len(text) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    n = len(values)
    filled = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    filled[:n] = values
    rows = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and its offsets into them."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], dtype=kind, count=len(column) + 1, offset=column.offset * kind().itemsize).astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8), at


def _pieces(sizes: np.ndarray, length: int):
    """Lists of (text, from, to) of at most SLICE bytes together; long texts come in parts that share
    length - 1 bytes, so that each window is in one part."""
    held, room = [], SLICE
    for i in np.flatnonzero(sizes >= length).tolist():
        for a in range(0, int(sizes[i]) - length + 1, SLICE // 2):
            b = min(a + SLICE // 2 + length - 1, int(sizes[i]))
            if held and b - a > room:
                yield held
                held, room = [], SLICE
            held.append((i, a, b))
            room -= b - a
    if held:
        yield held


def fragments_of(column: pa.Array, length: int = LENGTH) -> list[np.ndarray]:
    """Of every fragment of the texts: text, start, windows, the gram's offset, the gram's hash and the
    fragment's hash. Of equal hashes in a window the first counts."""
    gram = length * 8 // 25
    width = length - gram + 1
    data, at = _bytes_of(column)
    out = []
    low = np.uint64(SLICE - 1)
    for pieces in _pieces(np.diff(at), length):
        text = np.concatenate([data[at[i] + a : at[i] + b] for i, a, b in pieces])
        sizes = np.array([b - a for _, a, b in pieces])
        base = np.cumsum(sizes) - sizes
        hashes = _gram_hashes(text, gram)
        least = _smallest((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), width) & low
        windows = sizes - length + 1
        piece = np.repeat(np.arange(len(sizes)), windows)
        start = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows) + base[piece]
        gram_at = least[start].astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(gram_at) != 0) | (np.diff(piece) != 0)]))
        count = np.diff(np.append(new, len(start)))
        piece, start, gram_at = piece[new], start[new], gram_at[new]
        view = memoryview(text)
        digest = xxhash.xxh3_64_intdigest
        hashed = np.array([digest(view[a:b]) for a, b in zip(start.tolist(), (start + count + length - 1).tolist())], dtype=np.uint64)
        owner, begun = np.array([i for i, _, _ in pieces]), np.array([a for _, a, _ in pieces])
        out.append((owner[piece], start - base[piece] + begun[piece], count, gram_at - start, hashes[gram_at].view(np.int64), hashed.view(np.int64)))
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, dtype=np.int64)] * 6


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _by_tag(df: DataFrame) -> DataFrame:
    """The texts written once, in buckets of their tags: later joins by tag do not move them again."""
    spark: SparkSession = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"texts_{uuid.uuid4().hex}"
    (df.repartition(n, "tag").write.bucketBy(n, "tag").option("path", scratch_path(spark, "texts")).option("compression", "zstd")
        .format("parquet").saveAsTable(name))
    texts = spark.table(name)
    texts.count()  # resolves the files
    spark.sql(f"DROP TABLE {name}")  # only the name: the files lie outside the warehouse
    return texts


def repeated_spans(texts: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(tag, start, end) of byte spans that, together, cover every string of ``length`` bytes that starts at two
    places or more. ``texts`` has one row for each tag: tag, text."""
    def mark(batches):
        for batch in batches:
            row, start, windows, offset, gram, digest = fragments_of(batch.column(1), length)
            if len(row):
                yield pa.RecordBatch.from_pydict({
                    "tag": batch.column(0).take(pa.array(row)), "start": pa.array(start), "windows": pa.array(windows.astype(np.int32)),
                    "offset": pa.array(offset.astype(np.int32)), "gram": pa.array(gram), "digest": pa.array(digest)})
            give_back()

    marks = _written(texts.select("tag", "text").mapInArrow(
        mark, "tag bigint, start bigint, windows int, offset int, gram bigint, digest bigint"), "marks")
    kinds = cut_lineage(marks.groupBy("gram", "digest").agg(
        F.count("*").alias("n"), F.min("tag").alias("tag"), F.min_by("start", "tag").alias("start"),
        F.min("windows").alias("windows"), F.min("offset").alias("offset")))
    grams = cut_lineage(kinds.groupBy("gram").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).where("all > 1"))
    common = cut_lineage(join_hot(kinds, grams, ["gram"], "kinds"))
    # A fragment that occurs twice is repeated as a whole, whatever else meets its gram.
    sure = common.where("n > 1").select("gram", "digest", "n", F.lit(0).alias("first"), (F.col("windows") - 1).alias("last"))
    wanted = common.where("kinds > 1").groupBy("tag").agg(F.collect_list(F.struct("gram", "digest", "n", "kinds", "start", "windows", "offset")).alias("wanted"))

    def cut(batches):
        for batch in batches:
            data, at = _bytes_of(batch.column(0))
            view = memoryview(data)
            lists = batch.column(1)
            begin = np.repeat(at[:-1], pc_lengths(lists))
            flat = lists.flatten()
            start = flat.field("start").to_numpy() + begin
            end = start + flat.field("windows").to_numpy() + length - 1
            yield pa.RecordBatch.from_arrays(
                [flat.field("gram"), flat.field("digest"), flat.field("n"), flat.field("kinds"), flat.field("offset"),
                 pa.array([view[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary())],
                names=["gram", "digest", "n", "kinds", "offset", "bytes"])

    fragments = _written(texts.join(wanted.hint("shuffle_hash"), "tag").select("text", "wanted").mapInArrow(
        cut, "gram bigint, digest bigint, n bigint, kinds bigint, offset int, bytes binary"), "fragments")

    def sort(batches):
        held, grams, size = [], set(), 0

        def found():
            first, last = repeated_windows([r["bytes"] for r in held], [r["offset"] for r in held], length)
            some = [k for k in np.flatnonzero(last >= 0).tolist() if held[k]["n"] == 1]
            return pa.RecordBatch.from_pydict({
                "gram": pa.array([held[k]["gram"] for k in some], pa.int64()), "digest": pa.array([held[k]["digest"] for k in some], pa.int64()),
                "n": pa.array([1] * len(some), pa.int64()), "first": pa.array(first[some], pa.int32()), "last": pa.array(last[some], pa.int32())})

        for batch in batches:
            for row in batch.to_pylist():
                if size > SORT_BYTES and row["gram"] not in grams:
                    yield found()
                    held, grams, size = [], set(), 0
                held.append(row)
                grams.add(row["gram"])
                size += len(row["bytes"])
        if held:
            yield found()

    few = F.col("kinds") <= group_rows
    sorted_ = fragments.where(few).repartition("gram").sortWithinPartitions("gram").select("gram", "digest", "n", "offset", "bytes").mapInArrow(
        sort, "gram bigint, digest bigint, n bigint, first int, last int")
    # A gram that very many different fragments share: their windows are counted over the whole cluster.
    windows = fragments.where(~few).mapInArrow(lambda b: _windows(b, length), "gram bigint, digest bigint, n bigint, first int, w1 bigint, w2 bigint")
    many = cut_lineage(windows) if fragments.where(~few).limit(1).count() else None
    found = sure.unionByName(sorted_)
    if many is not None:
        twice = cut_lineage(many.groupBy("w1", "w2").agg(F.sum("n").alias("all"), F.count("*").alias("rows")).where("all > 1"))
        at = join_hot(many, twice, ["w1", "w2"], "rows").where("n = 1")
        found = found.unionByName(at.groupBy("gram", "digest").agg(
            F.first("n").alias("n"), F.min("first").alias("first"), F.max("first").alias("last")))
    spans = join_hot(marks, cut_lineage(found), ["gram", "digest"], "n")
    return spans.select("tag", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + F.lit(length)).alias("end"))


def pc_lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy())


def _windows(batches, length: int):
    """The windows of fragments, by a 128-bit hash of each."""
    for batch in batches:
        for row in batch.to_pylist():
            view = memoryview(row["bytes"])
            hashed = b"".join(xxhash.xxh3_128_digest(view[a : a + length]) for a in range(len(view) - length + 1))
            words = np.frombuffer(hashed, dtype="<i8").reshape(-1, 2)
            full = lambda name: pa.array(np.full(len(words), row[name]))
            yield pa.RecordBatch.from_pydict({
                "gram": full("gram"), "digest": full("digest"), "n": full("n"), "first": pa.array(np.arange(len(words), dtype=np.int32)),
                "w1": pa.array(np.ascontiguousarray(words[:, 0])), "w2": pa.array(np.ascontiguousarray(words[:, 1]))})


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", group_rows: int = GROUP_ROWS) -> DataFrame:
    """One row per input row: ``id_col``, n_bytes, n_removed, spans (array of start and end of the removed runs, in
    bytes, merged) and kept (the remaining bytes, which may end inside a character).

    A byte goes if a string of ``length`` bytes over it starts at any other place too, in the same or another row.
    Null texts are empty; texts shorter than ``length`` stay whole. Identifiers are only passed on: null and repeated
    ones are rows of their own, and a repeated row of enough bytes is removed in all its copies. An empty table gives
    an empty result; other columns are not read. ``length`` is 32 at least.
    """
    if length < 2 * BLOCK:
        raise ValueError(f"length is at least {2 * BLOCK}")
    texts = _by_tag(docs.select(F.monotonically_increasing_id().alias("tag"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    spans = repeated_spans(texts, length, group_rows).groupBy("tag").agg(F.collect_list(F.struct("start", "end")).alias("found"))

    def remove(batches):
        for batch in batches:
            data, at = _bytes_of(batch.column(1))
            view, rows = memoryview(data), []
            for base, end, found in zip(at[:-1].tolist(), at[1:].tolist(), batch.column(2).to_pylist()):
                merged: list[list[int]] = []
                for s in sorted((s["start"], s["end"]) for s in found or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                cuts = [0, *(c for s in merged for c in s), end - base]
                kept = b"".join(view[base + a : base + b] for a, b in zip(cuts[::2], cuts[1::2]))
                rows.append((end - base, end - base - len(kept), [{"start": a, "end": b} for a, b in merged], kept))
            n_bytes, n_removed, runs, kept = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "spans", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = texts.join(spans.hint("shuffle_hash"), "tag", "left").select("id", "text", "found").mapInArrow(
        remove, f"id {kind}, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    return out.withColumnRenamed("id", id_col)
