"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams.

Features are hashed n-grams of lower-cased words with boundary marks; term
frequency is relative, document frequencies are counted over all training
rows.  Weights are learned by follow-the-regularised-leader with an elastic
net (the first penalty keeps them sparse) on a bounded sample: about
``PER_CLASS`` documents of each language, chosen by a hash of the id.  A part
of the sample, held back from the fit, sets the temperature of the scores.

Prediction is one pass over whole texts: each distinct word of a slice is
scored once.  A text that is null or has no letter is ``und`` with score 0; so
is every text if no language can be learned.  Repeated rows get equal results.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clean, fold, map_arrow
from .ngrams import by_word, cell_counts, vocabulary, word_ngrams
from .textkit import list_array, slices

ORDERS = (1, 2, 3)
BITS = 16
PER_CLASS = 800
CALIBRATION = 5  # one of so many sampled documents sets the temperature
SCALE = 30.0
ALPHA, BETA, L1, L2, EPOCHS = 0.5, 1.0, 1e-3, 1e-4, 4
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def _vectors(docs: DataFrame) -> DataFrame:
    """(label, part, cells, counts, total): hashed n-gram counts of the sampled documents."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                words, vocab, index = vocabulary(part.column("text"))
                cells, begin = by_word(*word_ngrams(vocab, ORDERS, BITS), len(vocab))
                size = (begin[1:] - begin[:-1])[index]
                at = np.repeat(begin[index] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                row = np.repeat(words.doc, size)
                key, count = np.unique(row << BITS | cells[at], return_counts=True) if len(at) else (at, at)
                each = np.bincount(key >> BITS, minlength=words.docs)
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), part.column("part"), list_array(key & ((1 << BITS) - 1), each, pa.int32()),
                     list_array(count, each, pa.int32())], ["label", "part", "cells", "counts"])

    return map_arrow(docs, run, "label string, part int, cells array<int>, counts array<int>")


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_ftrl(rows: list[tuple], classes: int, size: int, epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights (size + 1, classes) from rows (cells, values, class); the last row is the bias."""
    z = np.zeros((size + 1, classes))
    n = np.zeros((size + 1, classes))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            cell, value, label = rows[i]
            at, x = np.append(cell, size), np.append(value, 1.0)
            za, na = z[at], n[at]
            w = _weights(za, na)
            error = _softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            step = (np.sqrt(na + g * g) - np.sqrt(na)) / ALPHA
            z[at] = za + g - step * w
            n[at] = na + g * g
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss, on a grid of ratios of 1.05."""
    grid = 0.1 * 1.05 ** np.arange(100)
    if not len(labels):
        return 1.0
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


class Model:
    """Languages, n-gram weights times inverse document frequency, bias, temperature."""

    def __init__(self, names: list[str], table: np.ndarray, bias: np.ndarray, heat: float):
        self.names, self.table, self.bias, self.heat = names, table, bias, heat

    def predict(self, texts: pa.Array) -> list[pa.Array]:
        words, vocab, index = vocabulary(texts)
        cells, owner = word_ngrams(vocab, ORDERS, BITS)
        k = len(self.names)
        each = np.stack([np.bincount(owner, self.table[cells, c], minlength=len(vocab)) for c in range(k)]
                        + [np.bincount(owner, minlength=len(vocab)).astype(float)], axis=1) if len(vocab) else np.zeros((0, k + 1))
        total = np.concatenate([np.zeros((1, k + 1)), np.cumsum(each[index], axis=0)])
        total = total[words.first[1:]] - total[words.first[:-1]]
        p = _softmax((SCALE * total[:, :k] / np.maximum(total[:, k:], 1.0) + self.bias) / self.heat)
        best = p.argmax(axis=1)
        known = np.array([t is not None and LETTER.search(t) is not None for t in texts.to_pylist()], dtype=bool)
        names = [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), known.tolist())]
        return [pa.array(names, pa.string()), pa.array(np.where(known, p[np.arange(len(p)), best], 0.0))]


def train(docs: DataFrame, text: str = "text", label: str = "lang", doc_id: str = "doc_id",
          per_class: int = PER_CLASS) -> Model | None:
    """Model learned from rows outside the held-out fold whose label is not null."""
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (fold(doc_id) != 2)).select(
        F.col(text).alias("text"), F.col(label).alias("label"),
        F.xxhash64(F.lit(11), F.col(doc_id).cast("string"), F.octet_length(text)).alias("key"), F.lit(0).alias("all"))
    count = cell_counts(rows, "text", "all", 1, ORDERS, BITS)[0]
    idf = np.log((1.0 + count[-1]) / (1.0 + count[:-1])) + 1.0
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    names = sorted(sizes)
    if not names:
        return None
    rate = F.coalesce(*[F.when(F.col("label") == name, F.lit(min(1.0, per_class / sizes[name]))) for name in names])
    unit = F.pmod(F.col("key"), F.lit(1 << 30)) / float(1 << 30)
    part = F.pmod(F.shiftright("key", 32), F.lit(CALIBRATION)).cast("int").alias("part")
    sample = _vectors(rows.where(unit < rate).select("text", "label", part)).toPandas()
    fitted, checked = [], []
    for row in sample.sort_values(["label", "part"], kind="stable").itertuples(index=False):
        if not len(row.cells):
            continue
        cell, tf = np.asarray(row.cells, dtype=np.int64), np.asarray(row.counts, dtype=float)
        item = (cell, SCALE * tf / tf.sum() * idf[cell], names.index(row.label))
        (checked if row.part == 0 else fitted).append(item)
    weights = fit_ftrl(sorted(fitted, key=lambda r: (r[2], len(r[0]), float(r[1].sum()))), len(names), 1 << BITS)
    logits = np.array([v @ weights[c] + weights[-1] for c, v, _ in checked]).reshape(len(checked), len(names))
    heat = temperature(logits, np.array([y for _, _, y in checked], dtype=np.int64))
    return Model(names, weights[:-1] * idf[:, None], weights[-1], heat)


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Documents plus lang_pred and score."""
    if model is None:
        return docs.drop("lang_pred", "score").withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS x languages numbers
    return add_columns(docs, text, "lang_pred string, score double", lambda texts: shared.value.predict(texts))


def report(docs: DataFrame) -> DataFrame:
    model = train(clean(docs, "doc_id", "text", "lang"))
    rows = clean(docs, "doc_id", "text").withColumn("held_out", fold("doc_id") == 2)
    return identify(rows, model).select("doc_id", "held_out", "lang_pred", "score")
