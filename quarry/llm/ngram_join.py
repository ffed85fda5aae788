"""N-gram Jaccard self-join by PartEnum signatures.

Sets of about equal size share a band. Within a band the domain of shingles is cut into partitions; two
sets whose symmetric difference has at most k elements differ in at most k partitions, so whoever lists
its non-empty partitions in one agreed order finds a common one among the first k + 1. A signature is what
a set has in such a partition (in the smallest bands: single shingles, or all subsets of two of the first
k + 2). Sets near a band's upper edge also sign in the next band. The order puts partitions made of very
frequent shingles last, which keeps shared passages out of the signatures but never out of the result.

Candidates share a signature. Each bucket's members are held against its most typical member; members that
stay in different components are then held against each other. Parity bitmaps, whose difference is a lower
bound of the sets' difference, spare most exact comparisons. No bucket is collected anywhere, and exact
copies are one set from the start.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import bloom_bits, bloom_words, give_back, in_bloom, text_slices
from quarry.llm.components import components
from quarry.session import Scratch, brief_shuffles

N = 5
SUBSETS, SINGLES, FIRST = 3, 16, 48  # lower edges of the two small bands and of the first partitioned one
LOAD = 1.5  # shingles per partition at a band's upper edge
MULTIPLIERS = np.array([(0x9E3779B97F4A7C15 * (2 * j + 1)) % 2**64 for j in range(1, N + 1)], dtype=np.uint64)
FREQUENT, FREQUENT_PER_TASK = 65_536, 4_096
FILTER_BITS = 29  # of a Bloom filter, as a power of two: 64 MB at most
FILTER_KEYS = 1 << 27  # keys that such a filter can still tell apart; more are joined
SETS_AT_ONCE = 2500
SHORT = 20  # signatures are counted, and looked up in the filter, without so many low bits
BUCKET_SHINGLES = 1_000_000  # of all sets, a bucket of the count; it has about 0.4 signatures for each
SIGNATURES_AT_ONCE = 1_000_000  # that a task gathers before it sends them to the buckets
COPIES = 1 << 23  # of sets, whose places are sent to the tasks (64 MB); beyond it copies are signed like other sets


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle sets of texts as sorted arrays of 64-bit hashes. Sizes and identities of sets come from all 64
    bits; signatures and intersections from the upper 48 (two unequal shingles of one pair of texts of a
    thousand shingles each meet there with a probability under 1e-8)."""

    def sets(self, texts: pa.Array):
        """Of each text: words between ASCII white space, A-Z lower-cased; the distinct runs of N words, or
        the whole sequence if there are fewer."""
        plain = pc.replace_substring(texts.cast(pa.large_string()), "\n", " ")
        if pc.any(pc.match_substring_regex(plain, "[\t\x0b\x0c\r]")).as_py():
            plain = pc.replace_substring_regex(plain, "[\t\x0b\x0c\r]", " ")
        lists = pc.split_pattern(plain, " ")
        coded = lists.flatten().dictionary_encode()
        numbers, offsets, words = coded.indices.to_numpy(), lists.offsets.to_numpy(), coded.dictionary
        offsets = offsets - offsets[0]
        blank = pc.index(words, "").as_py()
        # A-Z lower-cased; SipHash with a fixed key, the same in every process.
        hashes = pd.util.hash_array(pc.ascii_lower(words).to_numpy(zero_copy_only=False), categorize=False)
        if blank >= 0:  # between two blanks and at the ends
            full = numbers != blank
            offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
            numbers = numbers[full]
        h = hashes[numbers] if len(words) else np.zeros(0, np.uint64)
        runs = np.zeros(max(0, len(h) - N + 1), dtype=np.uint64)
        for j in range(N):
            runs += h[j : len(h) - N + 1 + j] * MULTIPLIERS[j]
        runs = _mix(runs)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= N:
                yield np.unique(runs[a : b - N + 1])
            elif b > a:
                yield _mix((h[a:b] * MULTIPLIERS[: b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def pack(shingles: np.ndarray) -> bytes:
    """The sorted hashes' upper 48 bits, byte plane by byte plane, which compresses well."""
    return shingles.view(np.uint8).reshape(-1, 8)[:, 2:].T.tobytes()


def unpack(raw) -> np.ndarray:
    """Ascending 48-bit hashes; as many as the set has shingles."""
    planes = np.frombuffer(raw, np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :6] = planes.T
    return out.view(np.uint64).ravel()


def _bands(size: int):
    """(number, lower edge, upper edge) of the bands a set signs in: its own, and the next one if a set
    there can be similar. Sets of fewer than SUBSETS shingles are similar only to themselves."""
    number, low, high = 0, SUBSETS, SINGLES
    while size >= SUBSETS:
        if low <= size < high or (size < low and 4 * size >= 3 * low):
            yield number, low, high
        if size < low:
            return
        number, low, high = number + 1, high, FIRST if number == 0 else high * 4


class Signer:
    """Signatures of shingle sets; ``frequent``: sorted hashes of very frequent shingles and their counts."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray):
        self.frequent, self.counts = frequent, counts

    def frequency(self, shingles: np.ndarray) -> np.ndarray:
        """Counts of the frequent shingles of a set, 0 for the others."""
        if not len(self.frequent):
            return np.zeros(len(shingles), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.frequent, shingles), len(self.frequent) - 1)
        return np.where(self.frequent[at] == shingles, self.counts[at], 0)

    def signatures(self, shingles: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of a set, and which of them stand for frequent shingles alone.

        A set that has fewer than k + 1 partitions with a rare shingle signs those, and then, like the sets of
        the band of single shingles, its first size / 4 + 1 shingles, rare ones first. Two similar sets of
        which one has k + 1 such partitions share one of them; otherwise both sign single shingles and
        meet in the first one they share. If that is a frequent one they have no rare shingle in common."""
        out, common, size, singles = [], [], len(shingles), False
        for number, low, high in _bands(size):
            seed = _mix(np.array([number + 1], dtype=np.uint64))
            if low == SINGLES:
                singles = True
                continue
            if low == SUBSETS:
                # |s - r| <= size / 4, and similar sets of three or more shingles share two.
                tokens = _mix(shingles ^ seed)
                at = _first(tokens, frequency, size // 4 + 2)
                at = at[np.argsort(tokens[at])]
                a, b = np.triu_indices(len(at), 1)
                out.append(_mix(tokens[at[a]] + _mix(tokens[at[b]])) ^ seed)
                common.append((frequency[at[a]] > 0) & (frequency[at[b]] > 0))
                continue
            parts = int(high / LOAD)
            part = (_mix(shingles ^ seed) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            part = part[order]
            at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            tokens = _mix(np.add.reduceat(_mix(shingles[order]), at) + _mix(part[at] ^ seed))
            rare = tokens[np.minimum.reduceat(frequency[order], at) == 0]
            first = (size + min(4 * size // 3, high - 1)) // 7 + 1  # k = |s - r| + |r - s| for any similar r of the band
            singles |= len(rare) < first  # also where its shingles fill fewer partitions than that
            chosen = np.partition(rare, first - 1)[:first] if len(rare) > first else rare
            out.append(chosen ^ seed)
            common.append(np.zeros(len(chosen), dtype=bool))
        if singles:
            seed = _mix(np.array([2], dtype=np.uint64))
            tokens = _mix(shingles ^ seed)
            at = _first(tokens, frequency, size // 4 + 1)
            out.append(tokens[at] ^ seed)
            common.append(frequency[at] > 0)
        if not out:
            return np.zeros(0, np.uint64), np.zeros(0, dtype=bool)
        return np.concatenate(out), np.concatenate(common)


def _first(tokens: np.ndarray, often: np.ndarray, n: int) -> np.ndarray:
    """Places of the n first tokens by (frequency, value)."""
    rare = np.flatnonzero(often == 0)
    if len(rare) > n:
        return rare[np.argpartition(tokens[rare], n - 1)[:n]]
    return np.lexsort((tokens, often))[:n]


def parity_bits(shingles: np.ndarray) -> bytes:
    """Whether an odd number of shingles falls on each of m places, m a power of two of at least twice the
    set's size. Each element in which two sets differ changes one bit."""
    m = 256
    while m < 2 * len(shingles) and m < 65_536:
        m *= 2
    return np.packbits(np.bincount((shingles & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1, bitorder="little").tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Differing bits of two parity bitmaps; the longer one is folded."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def similar(a: np.ndarray, b: np.ndarray, percent: int = 75) -> bool:
    """Whether 100 * intersection >= percent * union."""
    n = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * n >= percent * (len(a) + len(b) - n)


def _identify(kind: str, docs: DataFrame) -> DataFrame:
    """Per document: its id, set, the set's key and size, and the set itself with its place (once per task); per
    task: the shingles that several of its documents hold."""
    names = ["id", "set_id", "key", "n", "place", "shingles", "shingle", "times"]

    def run(batches):
        shingler, often, seen, place = Shingler(), {}, set(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in text_slices(batch.column(1)):
                sets = list(shingler.sets(texts))
                ids = [set_id(s) for s in sets]
                packed, places = [], range(place, place := place + len(sets))
                for i, s in zip(ids, sets):
                    packed.append(pack(s) if len(s) >= SUBSETS and i not in seen else None)
                    seen.add(i)
                if len(seen) > 200_000:
                    seen = set()  # a set may then be written again: it is made one later
                none = pa.nulls(len(sets), pa.int64())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(sets)), pa.array(ids, pa.binary()), pa.array(np.frombuffer(b"".join(i[:8] for i in ids), np.int64)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array([p if s is not None else None for p, s in zip(places, packed)], pa.int64()), pa.array(packed, pa.binary()),
                    none, none], names=names)
                values, counts = np.unique(np.concatenate(sets), return_counts=True)
                for v, c in zip((values[counts > 2] >> np.uint64(16)).tolist(), counts[counts > 2].tolist()):
                    often[v] = often.get(v, 0) + c
                if len(often) > 16 * FREQUENT_PER_TASK:
                    often = dict(sorted(often.items(), key=lambda x: (-x[1], x[0]))[: 4 * FREQUENT_PER_TASK])
                del sets, ids, packed, values, counts
            give_back()
        best = sorted(often.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT_PER_TASK]
        if best:
            n = len(best)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(n, batch.column(0).type), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                pa.array([v for v, _ in best], pa.int64()), pa.array([c for _, c in best], pa.int64())], names=names)

    return docs.mapInArrow(run, f"id {kind}, set_id binary, key bigint, n bigint, place bigint, shingles binary, shingle bigint, times bigint")


def _copies(sets: DataFrame, scratch: Scratch) -> np.ndarray:
    """Sorted places of the sets that another task, or the same one earlier, has written too. Their signatures would
    all count as shared ones. No place at all if there are too many of them to be sent to the tasks."""
    least = sets.groupBy("set_id").agg(F.min("place").alias("least"), F.count("*").alias("m")).where("m > 1")
    copies = scratch.keep(sets.select("set_id", "place").join(least, "set_id").where("place > least").select("place"))
    few = copies.count() <= COPIES
    places = np.sort(copies.toArrow().column("place").to_numpy()) if few else np.zeros(0, np.int64)
    scratch.drop(copies)
    return places


def _once(batch: pa.RecordBatch, copies: np.ndarray) -> pa.RecordBatch:
    """The batch, whose first column is the place, without the rows at the sorted places ``copies``."""
    if not len(copies):
        return batch
    places = batch.column(0).to_numpy()
    at = np.minimum(np.searchsorted(copies, places), len(copies) - 1)
    return batch.filter(pa.array(copies[at] != places))


def pack_ascending(x: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as the byte planes of their gaps, compressed: the closer, the shorter."""
    gaps = np.diff(x, prepend=np.uint64(0))
    return pa.compress(gaps.view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def unpack_ascending(raw, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, decompressed_size=8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _shared_signatures(sets: DataFrame, signer, copies) -> DataFrame:
    """(sig): what two or more signatures of the sets begin with, without their last SHORT bits. Tasks send sorted
    runs of them to buckets by their first bits; a bucket's runs meet in one place."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    bits = max(1, (total // BUCKET_SHINGLES).bit_length())

    def send(batches):
        own, held, n = signer.value, [], 0

        def runs():
            x = np.sort(np.concatenate(held))
            if len(x) > 2:  # what comes twice is shared, however often it comes
                x = x[np.concatenate([[True, True], x[2:] != x[:-2]])]
            bucket = (x >> np.uint64(64 - SHORT - bits)).astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            parts = np.split(x, at[1:])
            return pa.RecordBatch.from_pydict({"bucket": pa.array(bucket[at]), "m": pa.array([len(p) for p in parts], pa.int64()),
                                               "run": pa.array([pack_ascending(p) for p in parts], pa.binary())})

        for batch in (_once(b, copies.value) for b in batches):
            for at in range(0, batch.num_rows, SETS_AT_ONCE):
                some = (unpack(x.as_buffer()) for x in batch.column(1).slice(at, SETS_AT_ONCE))
                held.append(np.concatenate([own.signatures(s, own.frequency(s))[0] for s in some]) >> np.uint64(SHORT))
                n += len(held[-1])
                if n > SIGNATURES_AT_ONCE:
                    yield runs()
                    held, n = [], 0
            give_back()
        if n:
            yield runs()

    def meet(batches):
        def twice():
            x = np.sort(np.concatenate(held))
            return pa.RecordBatch.from_pydict({"sig": pa.array(np.unique(x[1:][x[1:] == x[:-1]]).view(np.int64))})

        bucket, held = None, []
        for batch in batches:
            for b, m, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if b != bucket and held:
                    yield twice()
                    held = []
                bucket = b
                held.append(unpack_ascending(run.as_buffer(), m))
        if held:
            yield twice()
        give_back()

    sent = sets.select("place", "shingles").mapInArrow(send, "bucket bigint, m bigint, run binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, "sig bigint")


def _candidates(sets: DataFrame, signer, copies, shared: DataFrame, most: int, scratch: Scratch) -> DataFrame:
    """Sets that hold a signature which may be another's too, with those signatures and the parity bitmap. Up to
    ``most`` shared signatures go into a Bloom filter of their number; more are joined with those of all sets."""
    schema = "set_id binary, key bigint, n bigint, rare bigint, typical double, sigs array<bigint>, common array<bigint>, parity binary"
    n = shared.count()
    words = sets.sparkSession.sparkContext.broadcast(bloom_words(shared, "sig", bloom_bits(n, FILTER_BITS)) if n <= most else None)

    def run(batches):
        own = signer.value
        for batch in (b.slice(at, SETS_AT_ONCE) for b in batches for at in range(0, b.num_rows, SETS_AT_ONCE)):
            rows, batch = [], _once(batch, copies.value)
            for i, key, raw in zip(*(batch.column(k) for k in (1, 2, 3))):
                s = unpack(raw.as_buffer())
                frequency = own.frequency(s)
                sigs, common = own.signatures(s, frequency)
                held = in_bloom(words.value, (sigs >> np.uint64(SHORT)).view(np.int64)) if words.value is not None else np.ones(len(sigs), dtype=bool)
                sigs = sigs.view(np.int64)
                if held.any():
                    rows.append((i.as_py(), key.as_py(), len(s), int((frequency == 0).sum()), float(np.log1p(frequency).mean()),
                                 sigs[held & ~common], sigs[held & common], parity_bits(s)))
            if rows:
                c = list(zip(*rows))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                names = ["set_id", "key", "n", "rare", "typical", "sigs", "common", "parity"]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, kinds)], names=names)

    found = sets.select("place", "set_id", "key", "shingles").mapInArrow(run, schema)
    if n <= most:
        return found
    found = scratch.keep(found)
    one = lambda col: found.select("set_id", F.lit(col).alias("of"), F.explode(col).alias("sig"))
    every = one("sigs").unionAll(one("common")).withColumn("short", F.shiftrightunsigned("sig", SHORT))
    kept = every.join(shared.withColumnRenamed("sig", "short"), "short", "left_semi").groupBy("set_id").agg(
        *[F.collect_list(F.when(F.col("of") == c, F.col("sig"))).alias(c) for c in ("sigs", "common")])  # at most a set's signatures
    return found.drop("sigs", "common").join(kept, "set_id")


def _full_sets(sets: DataFrame, copies, keys: DataFrame, owners: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, shingles) of the sets whose key is among ``keys``; a Bloom filter of their number keeps most others
    from being shuffled (what it lets through is dropped by the join)."""
    shared = keys.sparkSession.sparkContext.broadcast(bloom_words(keys, "key", bloom_bits(keys.count(), FILTER_BITS)))

    def run(batches):
        for batch in (_once(b, copies.value) for b in batches):
            yield batch.filter(pa.array(in_bloom(shared.value, batch.column(2).to_numpy()))).select(["set_id", "shingles"])

    some = sets.select("place", "set_id", "key", "shingles").mapInArrow(run, "set_id binary, shingles binary")
    return scratch.keep(some.join(owners, "set_id").groupBy("node").agg(F.first("shingles").alias("shingles")))


def _linked(pairs: DataFrame, candidates: DataFrame, sets: DataFrame, copies, owners: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of nodes that are similar: bitmaps first, then the sets themselves."""
    def near(batches):
        for batch in batches:
            a, b, pa_, pb, na, nb = (c.to_pylist() for c in batch.columns)
            keep = [bits_apart(x, y) * (100 + percent) <= (100 - percent) * (n + m) for x, y, n, m in zip(pa_, pb, na, nb)]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches):
        for batch in batches:
            x, y = batch.column(2), batch.column(3)
            keep = [similar(unpack(s.as_buffer()), unpack(t.as_buffer()), percent) for s, t in zip(x, y)]
            yield pa.RecordBatch.from_arrays(list(batch.columns[:2]), names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def side(name, df, *cols):
        return df.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in cols])

    close = pairs.select("a", "b").join(side("a", candidates, "parity", "n"), "a").join(side("b", candidates, "parity", "n"), "b")
    close = scratch.keep(close.select("a", "b", "parity_a", "parity_b", "n_a", "n_b").mapInArrow(near, "a bigint, b bigint"))
    nodes = close.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    keys = scratch.keep(candidates.join(nodes, "node").select("key"))
    full = _full_sets(sets, copies, keys, owners, scratch)
    both = close.join(side("a", full, "shingles"), "a").join(side("b", full, "shingles"), "b")
    links = scratch.keep(both.select("a", "b", "shingles_a", "shingles_b").mapInArrow(exact, "a bigint, b bigint"))
    scratch.drop(close, keys, full)
    return links


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                     filter_keys: int = FILTER_KEYS) -> DataFrame:
    """One row per row: id_col (an integer), n_shingles, component_id.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their shingle sets; component_id is
    the smallest identifier reachable by links, the row's own included. Null, empty and blank texts have no
    shingles and are linked with nothing, nor with one another. Rows with a null identifier are returned with their
    n_shingles and a null component, and link nothing. Repeated rows and identifiers are one document. Other
    columns are not read. Signatures are complete for percent >= 75. Up to ``filter_keys`` shared signatures are found
    by a filter, more by a join; both give the same rows.
    """
    if percent < 75:
        raise ValueError("signatures are made for percent >= 75")
    with brief_shuffles(docs.sparkSession):
        rows, owners, final = _placed(docs, id_col, text_col, percent, filter_keys)
    out = rows.join(owners, "set_id", "left").join(final, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("id").isNull(), None).otherwise(F.coalesce("component", "node", "id")).cast("bigint").alias("component_id"))


def _placed(docs: DataFrame, id_col: str, text_col: str, percent: int, filter_keys: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, set_id, n) of every row, (set_id, node) of every set, (node, component) of the linked ones, all written. What
    is written on the way is dropped as soon as it has been read for the last time."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scratch = Scratch(spark, "ngram-join")
    keep, drop = scratch.keep, scratch.drop
    first = keep(_identify(kind, plain))
    rows = keep(first.where(F.col("set_id").isNotNull()).select("id", "set_id", "n"))
    sets = first.where(F.col("place").isNotNull()).select("place", "set_id", "key", "n", "shingles")
    copies = spark.sparkContext.broadcast(_copies(sets, scratch))
    often = (first.where(F.col("shingle").isNotNull()).groupBy("shingle").agg(F.sum("times").alias("times"))
             .orderBy(F.desc("times"), "shingle").limit(FREQUENT).toArrow())
    hashes, counts = often.column("shingle").to_numpy().astype(np.uint64), often.column("times").to_numpy()
    order = np.argsort(hashes)
    signer = spark.sparkContext.broadcast(Signer(hashes[order], counts[order]))
    shared = keep(_shared_signatures(sets, signer, copies))

    # Nodes are sets, named by their smallest identifier.
    owners = keep(rows.where(F.col("id").isNotNull() & (F.col("n") > 0)).groupBy("set_id").agg(F.min("id").cast("bigint").alias("node")))
    once = _candidates(sets, signer, copies, shared, filter_keys, scratch).groupBy("set_id").agg(F.first(F.struct("key", "n", "rare", "typical", "sigs", "common", "parity")).alias("s"))
    candidates = keep(once.join(owners, "set_id").select("node", "s.*"))
    drop(shared)

    # Members that meet in a frequent shingle and share no rare one have at most their frequent ones in
    # common, so each needs percent (n + n') / (100 + percent) of them: that bounds its partner's size.
    largest = F.floor((100 + percent) * (F.col("n") - F.col("rare")) / percent) - F.col("n")
    members = candidates.select("node", "n", "typical", F.lit(None).cast("bigint").alias("largest"), F.explode("sigs").alias("sig")).unionAll(
        candidates.select("node", "n", "typical", largest.alias("largest"), F.explode("common").alias("sig")))
    centres = members.groupBy("sig").agg(F.max(F.struct("typical", "node", "n", "largest")).alias("c"), F.min("n").alias("least"), F.count("*").alias("m"))
    centres = keep(centres.where(F.col("m") > 1).select(
        "sig", F.col("c.node").alias("centre"), F.col("c.n").alias("n_c"), F.col("c.largest").alias("largest_c"), "least"))
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    allows = lambda most, n: F.coalesce(n <= most, F.lit(True))
    members = keep(members.drop("typical").join(centres, "sig").where(allows(F.col("largest"), F.col("least"))).drop("least"))
    drop(centres)
    spokes = members.where((F.col("node") != F.col("centre")) & fits(F.col("n"), F.col("n_c"))
                           & allows(F.col("largest"), F.col("n_c")) & allows(F.col("largest_c"), F.col("n")))
    spokes = keep(spokes.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    links = _linked(spokes, candidates, sets, copies, owners, percent, scratch)
    labels = components(links)
    drop(links)

    # Buckets whose members are not all connected yet: members of different components are held against
    # each other. Members of one component need no further link.
    placed = keep(members.join(labels, "node", "left").select("sig", "node", "n", "largest", F.coalesce("label", "node").alias("label")))
    open_ = keep(placed.groupBy("sig").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("sig"))
    drop(members)
    left = placed.join(open_, "sig")
    other = left.select("sig", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("label").alias("label_b"), F.col("largest").alias("largest_b"))
    pairs = left.withColumnRenamed("node", "a").join(other, "sig").where(
        (F.col("a") < F.col("b")) & (F.col("label") != F.col("label_b")) & fits(F.col("n"), F.col("n_b")) 
        & allows(F.col("largest"), F.col("n_b")) & allows(F.col("largest_b"), F.col("n")))
    pairs = keep(pairs.select("a", "b").distinct())
    drop(placed, open_)
    more = _linked(pairs.join(spokes, ["a", "b"], "left_anti"), candidates, sets, copies, owners, percent, scratch)
    drop(candidates, spokes, pairs, first)
    label_of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    between = more.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left").select(
        F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    # Links between components join their labels; a node's label then takes its own label's.
    joined = components(between)
    drop(more)
    final = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left").select(
        "node", F.coalesce("top", "label").alias("component"))
    alone = joined.join(labels, "node", "left_anti").select("node", F.col("label").alias("component"))
    return rows, owners, keep(final.unionAll(alone))
