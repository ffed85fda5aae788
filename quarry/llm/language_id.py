"""Language ID with a byte convolutional network, trained and applied in numpy.

Filters of several widths slide over a window of bytes; each filter's maximum over the window, rectified,
feeds a softmax over the languages. A text is cut into windows of a fixed length that cover all its bytes;
its probabilities are the windows' mean. Training reads a bounded sample of labelled windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import row_fraction, texts_of

WINDOW = 256
WIDTHS = (2, 3, 4)
UNDECIDED = "und"
#: Upper-case ASCII counts as lower case.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


class ByteCnn:
    """Weights: per width an array (width, 256, filters) and a bias; then a dense layer to the classes."""

    def __init__(self, classes: list[str], filters: int = 8, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.classes = classes
        self.conv = [rng.normal(0, 0.3, (w, 256, filters)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(filters, np.float32) for _ in WIDTHS]
        self.dense = rng.normal(0, 0.2, (filters * len(WIDTHS), len(classes))).astype(np.float32)
        self.top = np.zeros(len(classes), np.float32)

    def fit(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64,
            rate: float = 0.01, seed: int = 7) -> None:
        """Adam on the cross-entropy. windows: uint8 (n, WINDOW), zero-padded; lengths: bytes in use."""
        rng = np.random.default_rng(seed)
        params = [*self.conv, *self.bias, self.dense, self.top]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grads = self._gradients(windows[rows], lengths[rows], labels[rows])
                step += 1
                for p, g, m, v in zip(params, grads, first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, x, lengths, y):
        n, pooled, where = len(y), [], []
        xt = np.ascontiguousarray(x.T)
        for w, conv, bias in zip(WIDTHS, self.conv, self.bias):
            spots = WINDOW - w + 1
            h = sum(conv[j][xt[j : j + spots]] for j in range(w))
            h[np.arange(spots)[:, None] >= np.maximum(1, lengths - w + 1)[None, :]] = -1e9
            where.append(h.argmax(0))
            pooled.append(h.max(0) + bias)
        z = np.maximum(np.concatenate(pooled, 1), 0)
        p = _softmax(z @ self.dense + self.top)
        p[np.arange(n), y] -= 1
        p /= n
        dz = (p @ self.dense.T) * (z > 0)
        convs, biases, filters = [], [], self.conv[0].shape[2]
        for k, w in enumerate(WIDTHS):
            d = dz[:, k * filters : (k + 1) * filters]
            g = np.zeros_like(self.conv[k])
            for j in range(w):
                np.add.at(g[j], (x[np.arange(n)[:, None], where[k] + j], np.arange(filters)[None, :]), d)
            convs.append(g)
            biases.append(d.sum(0))
        return [*convs, *biases, z.T @ p, p.sum(0)]

    def prepare(self) -> ByteCnn:
        """Sums of neighbouring filter columns for all byte pairs, so that a width costs one or two lookups."""
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        two, three, four = self.conv
        self.tables = (pair(*two), pair(three[0], three[1]), three[2], pair(four[0], four[1]), pair(four[2], four[3]))
        return self

    def probabilities(self, xt: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
        """(windows, classes) from folded bytes, transposed to (WINDOW, windows); lengths if some are padded."""
        pairs = (xt[:-1].astype(np.int32) << 8) | xt[1:]
        two, three, third, four, fourth = self.tables
        maps = (two[pairs], three[pairs[:-1]] + third[xt[2:]], four[pairs[:-2]] + fourth[pairs[2:]])
        pooled = []
        for w, h, bias in zip(WIDTHS, maps, self.bias):
            if lengths is not None:
                h[np.arange(WINDOW - w + 1)[:, None] >= np.maximum(1, lengths - w + 1)[None, :]] = -1e9
            pooled.append(h.max(0) + bias)
        return _softmax(np.maximum(np.concatenate(pooled, 1), 0) @ self.dense + self.top)

    def of_texts(self, texts: list[bytes], at_once: int = 256) -> np.ndarray:
        """Mean probabilities of whole, non-empty texts: windows end to end, the last one moved back to the
        text's end; shorter texts are padded."""
        sizes = np.array([len(t) for t in texts])
        out = np.zeros((len(texts), len(self.classes)))
        short = np.flatnonzero(sizes < WINDOW)
        for rows in np.array_split(short, max(1, -(-len(short) // at_once))):
            if len(rows):
                x = np.zeros((len(rows), WINDOW), np.uint8)
                for k, r in enumerate(rows):
                    x[k, : sizes[r]] = np.frombuffer(texts[r], np.uint8)
                out[rows] = self.probabilities(np.ascontiguousarray(FOLD[x].T), sizes[rows])
        long = np.flatnonzero(sizes >= WINDOW)
        if len(long):
            joined = FOLD[np.frombuffer(b"".join([texts[i] for i in long]), np.uint8)]
            begin = np.concatenate([[0], np.cumsum(sizes[long])[:-1]])
            count = -(-sizes[long] // WINDOW)
            owner = np.repeat(np.arange(len(long)), count)
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = begin[owner] + np.minimum(nth * WINDOW, (sizes[long] - WINDOW)[owner])
            sums = np.zeros((len(long), len(self.classes)))
            span = np.arange(WINDOW)[:, None]
            for a in range(0, len(start), at_once):
                p = self.probabilities(joined[start[None, a : a + at_once] + span])
                np.add.at(sums, owner[a : a + at_once], p)
            out[long] = sums / count[:, None]
        return out


def _softmax(x):
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train_language_model(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                         per_language: int = 1500, held_out_third: bool = True, epochs: int = 6) -> ByteCnn:
    """Train on about ``per_language`` windows of each language, taken by hashes of the row: one from each
    sampled document, or up to 8 where there are few documents. With ``held_out_third`` documents whose crc32(id as text) mod 3 is 1 are left out.
    Rows without text or language are no samples. Every other window is cut to a shorter length, so
    that short texts are known too."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.length(text_col) > 0))
    if held_out_third:
        labelled = labelled.where(~in_held_out(F.col(id_col)))
    counts = {r[0]: r[1] for r in labelled.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n")).collect()}
    classes = sorted(counts)
    if not classes:
        return ByteCnn([])
    share = F.create_map(*[x for c in classes for x in (F.lit(c), F.lit(min(1.0, per_language / counts[c])))])
    times = F.create_map(*[x for c in classes for x in (F.lit(c), F.lit(max(1, min(8, per_language // counts[c]))))])
    text, n = F.col(text_col), F.length(text_col)
    start = F.pmod(F.xxhash64(F.col("nth"), F.col(id_col), text), F.greatest(F.lit(1), n - WINDOW + 1)).cast("int") + 1
    rows = (
        labelled.where(row_fraction(F.lit("sample"), F.col(id_col), F.col(text_col)) < F.element_at(share, F.col(lang_col)))
        .select(id_col, text_col, lang_col, F.explode(F.sequence(F.lit(1), F.element_at(times, F.col(lang_col)))).alias("nth"))
        .select(F.xxhash64(id_col, text_col, "nth").alias("key"), F.col(lang_col).alias("lang"), F.substring(text, start, F.lit(WINDOW)).alias("text"))
        .toArrow().sort_by([("key", "ascending"), ("text", "ascending")])
    )
    rng = np.random.default_rng(11)
    x, lengths = np.zeros((rows.num_rows, WINDOW), np.uint8), np.zeros(rows.num_rows, np.int64)
    for k, t in enumerate(rows.column("text").to_pylist()):
        raw = t.encode()[: WINDOW if k % 2 else int(rng.integers(12, WINDOW))]
        x[k, : len(raw)] = np.frombuffer(raw, np.uint8)
        lengths[k] = len(raw)
    index = {c: i for i, c in enumerate(classes)}
    model = ByteCnn(classes)
    labels = np.array([index[v] for v in rows.column("lang").to_pylist()])
    model.fit(FOLD[x], lengths, labels, epochs=max(epochs, -(-25_000 // max(1, len(labels)))))  # few samples are seen more often
    return model


def in_held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def with_language(docs: DataFrame, model: ByteCnn, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score",
                  keep=None) -> DataFrame:
    """All columns of ``docs``, and its whole texts' predicted language and that language's probability.

    Null texts and texts without a letter get ``und`` with score 0; so do all texts if the model has learned
    no language. Columns named like the two new ones are replaced. ``keep(predictions, scores)`` may give a
    mask of the rows to keep. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop(pred_col, score_col)
    at = base.columns.index(text_col)
    schema = T.StructType([*base.schema.fields, T.StructField(pred_col, T.StringType()), T.StructField(score_col, T.DoubleType())])

    def run(batches):
        cnn = shared.value
        if cnn.classes:
            cnn.prepare()
        for batch in batches:
            texts = texts_of(batch.column(at))
            lang, score = np.full(len(texts), UNDECIDED, dtype=object), np.zeros(len(texts))
            told = [k for k, t in enumerate(texts) if cnn.classes and any(map(str.isalpha, t))]
            if told:
                p = cnn.of_texts([texts[k].encode() for k in told])
                lang[told] = np.array(cnn.classes, dtype=object)[p.argmax(1)]
                score[told] = np.clip(p.max(1), 0, 1)
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)],
                                             names=[*batch.schema.names, pred_col, score_col])
            yield out.filter(pa.array(keep(lang, score))) if keep is not None else out

    return base.mapInArrow(run, schema)
