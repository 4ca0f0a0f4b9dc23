"""Language identification with a byte convolutional network in numpy.

A text's lower-cased UTF-8 bytes are cut into fixed-length windows.  Filters
of several widths slide over the bytes of a window (one weight per byte value
and place), each filter keeps its largest response, and a softmax over these
gives the language.  A text's distribution is the mean over all its windows.

The network is fitted on a bounded sample: at most ``docs_per_lang`` documents
of each language by hash order and ``windows_per_doc`` windows spread over
each.  Prediction covers whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changelake.llm.common import learnable, map_arrow, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
DOCS_PER_LANG = 300
WINDOWS_PER_DOC = 4
EPOCHS = 8
BATCH = 64
RATE = 0.01
SEED = 7
WINDOWS_AT_ONCE = 256
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
SPAN = WINDOW - max(WIDTHS) + 1


def has_letter(text: str) -> bool:
    """Whether a text has a letter; numerals such as a half or a circled one are none."""
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def windows(text: str) -> np.ndarray:
    """All bytes of a text as rows of WINDOW bytes, the last padded with zeros."""
    raw = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(rows * WINDOW, np.uint8)
    out[:len(raw)] = raw
    return out.reshape(rows, WINDOW)


class ByteNet:
    """Filters ``tables[width][place, byte, filter]``, their biases, and the softmax layer."""

    def __init__(self, langs: list[str], seed: int = SEED):
        rnd = np.random.default_rng(seed)
        self.langs = langs
        self.tables = {w: rnd.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.out = rnd.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs))).astype(np.float32)
        self.out_bias = np.zeros(len(langs), np.float32)

    def _softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam on the cross entropy; the gradient passes a filter only at its largest response."""
        rnd = np.random.default_rng(seed)
        params = [*self.tables.values(), self.bias, self.out, self.out_bias]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        step = 0
        for _ in range(epochs):
            order = rnd.permutation(len(x))
            for at in range(0, len(x), BATCH):
                rows, want = x[order[at:at + BATCH]], y[order[at:at + BATCH]]
                best, pooled = {}, []
                for w, table in self.tables.items():
                    response = table[0][rows[:, :SPAN]]
                    for j in range(1, w):
                        response += table[j][rows[:, j:j + SPAN]]
                    best[w] = response.argmax(axis=1)
                    pooled.append(np.take_along_axis(response, best[w][:, None, :], 1)[:, 0])
                active = np.concatenate(pooled, axis=1) + self.bias
                hidden = np.maximum(active, 0)
                z = hidden @ self.out + self.out_bias
                z = np.exp(z - z.max(axis=1, keepdims=True))
                error = z / z.sum(axis=1, keepdims=True)
                error[np.arange(len(want)), want] -= 1
                error /= len(want)
                back = (error @ self.out.T) * (active > 0)
                grads = []
                for k, (w, table) in enumerate(self.tables.items()):
                    grad, part = np.zeros_like(table), back[:, k * FILTERS:(k + 1) * FILTERS]
                    for j in range(w):
                        byte = np.take_along_axis(rows, best[w] + j, 1)
                        np.add.at(grad[j], (byte, np.arange(FILTERS)[None, :]), part)
                    grads.append(grad)
                grads += [back.sum(0), hidden.T @ error, error.sum(0)]
                step += 1
                for p, g, (m, v) in zip(params, grads, moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def frozen(self) -> FrozenNet:
        return FrozenNet(self)


class FrozenNet:
    """The network for prediction: responses of byte pairs are added up beforehand."""

    def __init__(self, net: ByteNet):
        two, three, four = (net.tables[w] for w in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        self.first = np.concatenate([pair(two[0], two[1]), pair(three[0], three[1]), pair(four[0], four[1])], axis=1)
        self.second = np.concatenate([pair(three[2], np.zeros_like(three[2])), pair(four[2], four[3])], axis=1)
        self.net = net

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Probabilities of each window."""
        out = []
        for at in range(0, len(rows), WINDOWS_AT_ONCE):
            x = rows[at:at + WINDOWS_AT_ONCE].astype(np.int32)
            pairs = x[:, :-1] * 256 + x[:, 1:]
            response = self.first[pairs[:, :SPAN]]
            response[:, :, FILTERS:] += self.second[pairs[:, 2:2 + SPAN]]
            out.append(self.net._softmax(response.max(axis=1)))
        return np.concatenate(out)


def training_sample(docs: DataFrame, docs_per_lang: int, windows_per_doc: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, windows and their language numbers, from learnable rows only."""
    known = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(1 << 20)).alias("draw"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"))
    # twice the wanted number by hash, so that the window below sees few rows of a language
    likely = (known.join(F.broadcast(counts), "lang")
              .where(F.col("draw") * F.col("n") < F.lit((1 << 20) * (2 * docs_per_lang + 50))))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    chosen = likely.select("lang", "doc_id", "draw", "text").withColumn("nth", nth).where(F.col("nth") <= docs_per_lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs, rows = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    w = windows(text)
                    for i in np.unique(np.linspace(0, len(w) - 1, windows_per_doc).astype(int)):
                        langs.append(lang)
                        rows.append(w[i].tobytes())
            yield pa.record_batch([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "bytes"])

    sample = sorted((r.lang, bytes(r.bytes)) for r in map_arrow(chosen.select("lang", "text"), run, "lang string, bytes binary").collect())
    langs = sorted({lang for lang, _ in sample})
    number = {lang: i for i, lang in enumerate(langs)}
    x = np.frombuffer(b"".join(b for _, b in sample), np.uint8).reshape(len(sample), WINDOW)
    return langs, x, np.array([number[lang] for lang, _ in sample], np.int64)


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> ByteNet | None:
    """A network fitted on the sample (None without any labelled text)."""
    langs, x, y = training_sample(docs, docs_per_lang, windows_per_doc)
    if not langs:
        return None
    net = ByteNet(langs)
    net.fit(x, y)
    return net


def identify(docs: DataFrame, net: ByteNet | None) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc_id, lang_pred, score)``, one row per input row.

    ``lang_pred`` is a learned language, or ``und`` with score 0 for a text that is
    NULL or has no letter, and for every text where nothing could be learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few hundred KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value.frozen() if shared.value else None
        for batch in slices(batches):
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                if frozen is None or not text or not has_letter(text):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                rows = windows(text)
                total = frozen.predict(rows).mean(axis=0)
                langs.append(frozen.net.langs[int(total.argmax())])
                scores.append(float(min(1.0, total.max())))
            yield pa.record_batch([batch.column(0), pa.array(langs), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return map_arrow(narrow, run, "doc_id long, lang_pred string, score double")
