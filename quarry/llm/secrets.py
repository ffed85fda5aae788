"""Secret scans with DataFrame functions only.

Three fixed patterns find the base spans. Other long tokens are judged by two character Markov models, one
of random strings and one of ordinary identifiers, compared by their log-likelihood ratio. Both are bigram
counts from a bounded sample of documents, labelled by the patterns: values of base spans are random
strings, long words of letters outside them are ordinary.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import row_fraction

#: Kind, pattern, least length of the value (the pattern's last group, or the whole match). A
#: run of access or hex characters is matched whole or not at all, so its least length is in the pattern
#: itself; an assignment whose value is too short still uses up its text and is dropped afterwards.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 20),
    ("hex", r"[0-9a-f]{24,}", 24),
)
LEARNED = "markov"
KINDS = (*(k for k, _, _ in BASE), LEARNED)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = "[A-Za-z0-9+/_=-]{%d,}"
BLOCK = 256


@dataclass(frozen=True)
class MarkovPair:
    """log P(next | character) of random strings minus that of ordinary identifiers, by pairs of ALPHABET."""

    ratios: tuple[float, ...]

    def score(self, token: Column) -> Column:
        """Mean log-likelihood ratio per step of a token over ALPHABET."""
        table = F.split(F.lit(",".join(f"{x:.6f}" for x in self.ratios)), ",").cast("array<double>")  # one constant
        at = lambda i: F.instr(F.lit(ALPHABET), F.substr(token, i, F.lit(1)))
        pair = lambda i: F.element_at(table, (at(i) - 1) * len(ALPHABET) + at(i + 1))
        steps = F.sequence(F.lit(1), F.length(token) - 1)
        return F.aggregate(steps, F.lit(0.0), lambda s, i: s + pair(i)) / (F.length(token) - 1)


def _prefix_sums(values: Column) -> Column:
    """Running sums of an array of integers, by blocks: linear in its length, not quadratic."""
    def run(start, part):
        return F.slice(F.aggregate(part, F.array(start), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x)), 2, BLOCK)

    blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int") - 1), lambda b: F.slice(values, b * BLOCK + 1, BLOCK))
    totals = F.transform(blocks, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x))
    starts = F.aggregate(totals, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
    return F.flatten(F.transform(blocks, lambda p, i: run(F.element_at(starts, i + 1), p)))


def _spans(text: Column, found: Column, pattern: str, kind: int) -> Column:
    """The matches ``found`` of a pattern as an array of (start, kind, end, text), in code points. The
    pieces between the matches give the positions; texts without a match are not split."""
    pieces = F.split(text, pattern, -1)
    # What lies between the ends of match i-1 and match i, plus match i: running sums are the ends.
    steps = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
    spans = F.zip_with(_prefix_sums(steps), found, lambda end, m: F.struct(
        (end - F.length(m)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("text")))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,text:string>>")
    return F.when(F.size(found) > 0, spans).otherwise(empty)


def _located(docs: DataFrame, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """Add an array of spans per name from leftmost non-overlapping matches of (pattern, kind) in ``text``."""
    for name, (pattern, _) in patterns.items():
        docs = docs.withColumn(f"{name}_found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    return docs.select("*", *[_spans(F.col("text"), F.col(f"{n}_found"), p, k).alias(n) for n, (p, k) in patterns.items()])


def _value(kind: int, match: Column) -> Column:
    """What a match stands for: an assignment's value, else the match itself."""
    return F.regexp_extract(match, BASE[0][1], 2) if kind == 0 else match


PATTERNS = {kind: (pattern, k) for k, (kind, pattern, _) in enumerate(BASE)}


def _base_spans() -> Column:
    """All base spans, unsorted; matches whose value is too short are dropped after matching."""
    def long_enough(kind, least):
        return lambda span: F.length(_value(kind, span["text"])) >= least

    return F.concat(*[F.filter(kind, long_enough(k, least)) for k, (kind, _, least) in enumerate(BASE)])


def _bigrams(samples: DataFrame) -> dict[bool, dict[str, int]]:
    """Counts of character pairs per class: at most 2 * len(ALPHABET) ** 2 rows reach the driver."""
    pairs = samples.where(F.length("token") > 1).select("is_random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("token") - 1), lambda i: F.substr(F.col("token"), i, F.lit(2)))).alias("pair"))
    pairs = pairs.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
    out = {True: {}, False: {}}
    for r in pairs.groupBy("is_random", "pair").agg(F.count("*").alias("n")).collect():
        out[r.is_random][r.pair] = r.n
    return out


def train_markov(samples: DataFrame, smoothing: float = 0.5) -> MarkovPair:
    """Both models from labelled tokens: ``samples`` has token and is_random. Add-``smoothing`` counts, so
    a class without any sample is uniform."""
    size = len(ALPHABET)
    counts = _bigrams(samples)
    logs = []
    for is_random in (True, False):
        n = counts[is_random]
        rows = {a: sum(n.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
        logs.append([math.log((n.get(a + b, 0) + smoothing) / (rows[a] + smoothing * size)) for a in ALPHABET for b in ALPHABET])
    return MarkovPair(tuple(r - o for r, o in zip(*logs)))


def labelled_tokens(docs: DataFrame, text_col: str = "text", sample_docs: int = 20_000, least: int = 8) -> DataFrame:
    """(token, is_random) from about ``sample_docs`` documents, taken by a hash of the text: values of base
    spans, and words of ``least`` or more letters."""
    total = max(1, docs.count())
    text = F.coalesce(F.col(text_col), F.lit(""))
    part = docs.select(text.alias("text")).where(row_fraction(F.col("text")) < sample_docs / total)
    value = lambda s: F.when(s["kind"] == 0, _value(0, s["text"])).otherwise(s["text"])
    random = _located(part, PATTERNS).select(F.explode(F.transform(_base_spans(), value)).alias("token"), F.lit(True).alias("is_random"))
    words = F.regexp_extract_all(F.col("text"), F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{%d,}(?![A-Za-z0-9+/_=-])" % least), F.lit(0))
    return random.unionAll(part.select(F.explode(words).alias("token"), F.lit(False).alias("is_random")))


def find_secrets(docs: DataFrame, model: MarkovPair, threshold: float = 0.5, least: int = 20, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per row: id_col, found (array of (start, kind, end, text), sorted), where kind indexes KINDS.

    Offsets are code points, ends exclusive. The learned kind is a token of ``least`` or more characters of
    ALPHABET that overlaps no base span and whose mean log-likelihood ratio is above ``threshold``. Null and
    empty texts have no spans; repeated rows stay; other columns are not read.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spans = _located(plain, PATTERNS | {LEARNED: (CANDIDATE % least, len(BASE))})
    spans = spans.select("id", _base_spans().alias("base"), LEARNED)
    apart = lambda s: ~F.exists(F.col("base"), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    learned = F.filter(F.filter(LEARNED, apart), lambda s: model.score(s["text"]) > threshold)
    learned = F.when(F.size(LEARNED) > 0, learned).otherwise(F.col(LEARNED))
    return spans.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", learned)).alias("found"))


def digest_columns(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id_col, n_assign, n_access, n_hex, n_markov, base_sha256, spans: counts, and kind:start:end lists."""
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    said = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])), ",")
    of = lambda k: F.filter("found", lambda s: s["kind"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select(id_col, *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("found")).alias("spans"))
