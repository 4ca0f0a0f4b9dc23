"""Quality classifier: naive Bayes support vectors on n-gram indicators.

Indicators of a text: its words and word pairs, and runs of one to three word
shapes (case, digits, marks, equal to the word before).  Each indicator is
scaled by the log ratio of its smoothed class frequencies; a linear
hinge-loss model is then fitted by dual coordinate descent, and its margin is
turned into a probability on the class shares of all labelled rows.

Fitted on a bounded sample: at most ``docs_per_class`` learnable labelled
documents of each class by hash order, and the ``max_features`` indicators
found in most of them.  Scoring reads whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.common import learnable, map_arrow, materialize, slices

DOCS_PER_CLASS = 2000
MAX_FEATURES = 20_000
MIN_DOCS = 5
PENALTY = 0.1
EPOCHS = 20
SEED = 11
SMOOTH = 1.0
THRESHOLD = 0.7
SHAPES_KEPT = 200_000
MARKS = re.compile(r"\w+|[^\w\s]+")

_shapes: dict[str, str] = {}


def _shape(word: str) -> str:
    """Case and kind of each run of a word, e.g. ``U!!`` or ``l&&&``."""
    out = []
    for run in MARKS.findall(word):
        if not (run[0].isalnum() or run[0] == "_"):
            out.append(run[:3])
        elif run.isdigit():
            out.append("0")
        elif run.isupper() and len(run) > 1:
            out.append("U")
        elif run[0].isupper():
            out.append("T")
        else:
            out.append("l")
    return "".join(out[:4])


def indicators(text: str) -> set:
    """The distinct n-grams of a text: words and word pairs, shapes in runs of one to three."""
    words = text.split()
    shapes = []
    last = None
    for word in words:
        if word == last:
            shapes.append("=")
            continue
        last = word
        shape = _shapes.get(word)
        if shape is None:
            if len(_shapes) >= SHAPES_KEPT:
                _shapes.clear()
            shape = _shapes[word] = _shape(word)
        shapes.append(shape)
    found = {("w", w) for w in set(words)}
    found.update(("w", a, b) for a, b in set(zip(words, words[1:])))
    found.update(("s", a) for a in set(shapes))
    found.update(("s", a, b) for a, b in set(zip(shapes, shapes[1:])))
    found.update(("s", a, b, c) for a, b, c in set(zip(shapes, shapes[1:], shapes[2:])))
    return found


def _name(gram: tuple) -> str:
    return "\x1f".join(gram)


class QualityModel:
    """Weights by indicator, and the map from margin to probability."""

    def __init__(self, prior: float):
        self.prior = prior
        self.weights: dict[tuple, float] = {}
        self.bias = 0.0
        self.slope, self.shift = 0.0, math.log(prior / (1 - prior))

    def margin(self, text: str) -> float:
        get = self.weights.get
        return self.bias + sum(get(g, 0.0) for g in indicators(text))

    def score(self, text: str) -> float:
        z = max(-30.0, min(30.0, self.slope * self.margin(text) + self.shift))
        return 1 / (1 + math.exp(-z))


def hinge_dual(rows: list[np.ndarray], values: np.ndarray, y: np.ndarray, n_features: int, penalty: float = PENALTY,
               epochs: int = EPOCHS, seed: int = SEED) -> tuple[np.ndarray, float]:
    """L1-loss linear SVM by dual coordinate descent: ``rows`` hold the features of
    each example, ``values`` each feature's value; returns weights and bias."""
    rnd = np.random.default_rng(seed)
    w, bias, alpha = np.zeros(n_features), 0.0, np.zeros(len(rows))
    square = np.array([values[r] @ values[r] + 1.0 for r in rows])
    for _ in range(epochs):
        moved = 0.0
        for i in rnd.permutation(len(rows)):
            r = rows[i]
            v = values[r]
            gradient = y[i] * (w[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), penalty)
            change = (new - alpha[i]) * y[i]
            if change:
                w[r] += change * v
                bias += change
                moved = max(moved, abs(change))
                alpha[i] = new
        if moved < 1e-4 * penalty:
            break
    return w, bias


def logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(y=1 | margin), each class weighing the same (Newton steps)."""
    t = np.where(y > 0, (np.sum(y > 0) + 1) / (np.sum(y > 0) + 2), 1 / (np.sum(y < 0) + 2))
    weight = np.where(y > 0, 0.5 / np.sum(y > 0), 0.5 / np.sum(y < 0))
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - t)))
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _sample(docs: DataFrame, labels: DataFrame, docs_per_class: int) -> tuple[DataFrame, float]:
    """``(doc_id, y, grams)`` of the sample, and the share of class 1 among all learnable labels."""
    marked = (labels.where(learnable() & F.col("quality").isin(0, 1))
              .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min("quality").alias("y")))
    marked = materialize(marked, "quality-labels")
    share = marked.agg(F.avg("y"), F.count("*")).first()
    if not share[1]:
        return docs.sparkSession.createDataFrame([], "doc_id long, y int, grams array<string>"), 0.5
    draw = F.xxhash64("label_id")
    chosen = None
    for y in (0, 1):
        # at most docs_per_class rows
        part = marked.where(F.col("y") == y).orderBy(draw, "label_id").limit(docs_per_class)
        chosen = part if chosen is None else chosen.unionAll(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 32):
            grams = [sorted(map(_name, indicators(t or ""))) for t in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(grams, pa.list_(pa.string()))], ["doc_id", "y", "grams"])

    # the table's other columns may have the names used here
    own = docs.where(learnable()).select(F.col("doc_id").cast("long").alias("own_id"), F.col("text").cast("string").alias("own_text"))
    texts = own.join(F.broadcast(chosen), F.col("own_id") == F.col("label_id"))
    sample = map_arrow(texts.select(F.col("label_id"), F.col("y").cast("int"), F.col("own_text")), run,
                       "doc_id long, y int, grams array<string>")
    return materialize(sample, "quality-sample"), float(share[0])


def train(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS, max_features: int = MAX_FEATURES) -> QualityModel:
    """Fit on the sample.  Labels are 0 or 1 (a document with both counts as 0); without
    both classes the model gives every text the share of class 1 (0.5 without labels)."""
    sample, prior = _sample(docs, labels, docs_per_class)
    model = QualityModel(min(max(prior, 0.001), 0.999))
    each = sample.select("doc_id", "y", F.explode("grams").alias("gram"))
    top = (each.groupBy("gram").agg(F.count("*").alias("n"), F.sum("y").alias("n1"))
           .where(F.col("n") >= MIN_DOCS).orderBy(F.desc("n"), "gram").limit(max_features))
    grams = top.collect()  # at most max_features rows
    number = {g.gram: i for i, g in enumerate(grams)}
    known = sample.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [np.array(sorted(known.value[g] for g in gs if g in known.value), np.int32) for gs in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "y", "f"])

    # at most 2 * docs_per_class rows of at most max_features numbers
    data = map_arrow(sample, run, "doc_id long, y int, f array<int>").collect()
    data.sort(key=lambda r: (r.doc_id, r.f))
    y = np.array([1 if r.y else -1 for r in data])
    if not len(data) or abs(y.sum()) == len(y):
        return model
    rows = [np.array(r.f, np.int64) for r in data]
    n1, n0 = int((y > 0).sum()), int((y < 0).sum())
    in1 = np.array([g.n1 for g in grams], float)
    in0 = np.array([g.n for g in grams], float) - in1
    ratio = np.log((in1 + SMOOTH) / (n1 + 2 * SMOOTH)) - np.log((in0 + SMOOTH) / (n0 + 2 * SMOOTH))
    w, bias = hinge_dual(rows, ratio, y, len(grams))
    # margins for the probabilities come from models that did not see the example
    fold = np.arange(len(rows)) % 3
    margin = np.zeros(len(rows))
    for k in range(3):
        seen = np.flatnonzero(fold != k)
        if abs(y[seen].sum()) == len(seen):
            continue
        wk, bk = hinge_dual([rows[i] for i in seen], ratio, y[seen], len(grams))
        for i in np.flatnonzero(fold == k):
            margin[i] = ratio[rows[i]] @ wk[rows[i]] + bk
    model.slope, shift = logistic(margin, y)
    model.shift = shift + math.log(model.prior / (1 - model.prior))
    model.bias = bias
    scaled = w * ratio
    model.weights = {tuple(g.gram.split("\x1f")): float(scaled[i]) for i, g in enumerate(grams) if scaled[i]}
    return model


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``docs(doc_id, text, ...)`` -> ``(doc, score)``: the input row as a struct and the
    probability that it is of class 1.  A NULL text scores as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(0).field("text").cast(pa.string()).to_pylist()
            yield pa.record_batch([batch.column(0), pa.array([shared.value.score(t or "") for t in texts], pa.float64())], ["doc", "score"])

    from pyspark.sql import types as T
    whole = docs.select(F.struct("*").alias("doc"))
    return map_arrow(whole, run, T.StructType([whole.schema["doc"], T.StructField("score", T.DoubleType())]))
