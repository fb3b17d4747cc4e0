"""Toxic spans by a linear-chain conditional random field.

Labels mark documents, so tokens are labelled from them: over all labelled
training rows, the share of toxic documents among those that hold a hashed
n-gram (or whole word) gives every token its evidence, the greatest among its
n-grams: log odds in bins, crossed with how many documents they rest on.  In a
toxic document the tokens of the strongest evidence are tagged, in clean
documents none.  The field learns emissions of a token's and its neighbours'
bins, and transitions, on a bounded sample: about ``PER_CLASS`` documents of
each label, chosen by a hash of the id and weighted back to all rows; their
evidence leaves the document itself out, so that words it alone holds tell
nothing.

A score combines the chances that any token and that the strongest token is
toxic, from forward-backward marginals of the whole text, with the length, by
logistic regression on the sample; tokens
with a marginal of one half or more are the offending spans.  Null or empty
texts have no tokens and get the calibrated score of that.  A document with
several label rows counts as toxic if one says so; null labels are left out.
Without labels of both kinds nothing can be learned and every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import add_columns, clean, fold, map_arrow
from .crf import Chains, fit, token_score
from .ngrams import by_word, cell_counts, vocabulary, word_ngrams
from .textkit import list_array, slices

ORDERS = (4, 5)
BITS = 18
STEPS = 24  # bins of log odds, from LOW to HIGH
LOW, HIGH = -4.0, 8.0
LEVELS = 6  # of support: documents that hold the n-gram, by powers of four
BINS = STEPS * LEVELS + 1  # 0 stands beyond the ends of a text
NEAR = 4  # bins below a document's strongest evidence that are tagged with it
SHRINK = 1.0  # documents of the base rate added to each n-gram
PER_CLASS = 800  # documents of each label that the field is fitted on, about
FIT_TOKENS = 8192  # words of each of them, at most
THRESHOLD = 0.3
TAGGED = 0.5


def _evidence(counts: np.ndarray, without: int | None = None) -> np.ndarray:
    """Bin of each cell: log odds of toxic, shrunk to the base rate, then support.
    ``without`` leaves out one document of that label (the one that is looked at)."""
    clean_docs, toxic = (np.maximum(counts[k, :-1] - (k == without), 0) for k in (0, 1))
    base = counts[1, -1] / max(counts[:, -1].sum(), 1.0)
    p = (toxic + SHRINK * base) / (toxic + clean_docs + SHRINK)
    step = np.clip(np.floor((np.log(p / (1.0 - p)) - LOW) / (HIGH - LOW) * STEPS), 0, STEPS - 1)
    level = np.clip(np.floor(np.log2(np.maximum(toxic + clean_docs, 1.0)) / 2), 0, LEVELS - 1)
    return (1 + step * LEVELS + level).astype(np.int16)


def _token_bins(texts: pa.Array, bins: np.ndarray):
    """Words of a slice and each token's bin, the greatest of its cells."""
    words, vocab, index = vocabulary(texts)
    cells, begin = by_word(*word_ngrams(vocab, ORDERS, BITS, True), len(vocab))
    best = np.maximum.reduceat(bins[cells], begin[:-1]) if len(vocab) else np.zeros(0, dtype=np.int16)
    return words, best[index].astype(np.int64)


def _tags(bins: np.ndarray, toxic: int) -> np.ndarray:
    """1 for the tokens of a toxic document that are nearest to its strongest evidence."""
    step = (bins - 1) // LEVELS
    if not toxic or not len(step):
        return np.zeros(len(step), dtype=np.int64)
    even = int((0.0 - LOW) / (HIGH - LOW) * STEPS)
    return (step >= min(max(step.max() - NEAR, even), step.max())).astype(np.int64)


def _sampled(docs: DataFrame, tables) -> DataFrame:
    """(id, toxic, bins) of the sampled documents: token evidence from all other documents."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                kinds = part.column("toxic").to_numpy(zero_copy_only=False)
                words, value = _token_bins(part.column("text"), tables.value[0])
                _, other = _token_bins(part.column("text"), tables.value[1])
                value = np.where(kinds[words.doc] == 1, other, value)
                count = np.minimum(words.count, FIT_TOKENS)
                kept = np.ones(len(value), dtype=bool)
                for row in np.flatnonzero(words.count > FIT_TOKENS).tolist():  # the words around the strongest evidence
                    lo, hi = words.first[row], words.first[row + 1]
                    begin = min(max(lo, lo + int(value[lo:hi].argmax()) - FIT_TOKENS // 2), hi - FIT_TOKENS)
                    kept[lo:begin], kept[begin + FIT_TOKENS:hi] = False, False
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("toxic"), list_array(value[kept], count, pa.int16())],
                    ["id", "toxic", "bins"])

    return map_arrow(docs, run, "id bigint, toxic int, bins array<smallint>")


class Model:
    """Bin of each cell, emission weights, transitions and the calibration of document scores."""

    def __init__(self, bins, weights, trans, scale):
        self.bins, self.weights, self.trans, self.scale = bins, weights, trans, scale

    def score(self, texts: pa.Array) -> list[pa.Array]:
        words, value = _token_bins(texts, self.bins)
        marginal = _marginals(value, words.count, self.weights, self.trans)
        logit = _any(marginal, words.first, words.count) @ self.scale
        score = 1.0 / (1.0 + np.exp(-np.clip(logit, -40, 40)))
        bad = np.flatnonzero(marginal >= TAGGED)
        chars = np.concatenate([[0], np.cumsum((words.buf & 0xC0) != 0x80)])
        origin = chars[words.offsets[words.doc[bad]]]
        spans = np.stack([chars[words.start[bad]] - origin, chars[words.end[bad]] - origin], axis=1).ravel()
        return [pa.array(score), list_array(spans, np.bincount(words.doc[bad], minlength=words.docs) * 2, pa.int32())]


def _marginals(value, lengths, weights, trans):
    starts = np.zeros(len(value), dtype=bool)
    starts[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    return Chains(lengths).marginals(token_score(value, starts, weights), trans)[0]


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _any(marginal: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per text: log odds that any token is toxic and that the strongest one is, log of its length, one."""
    none = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(marginal, 1 - 1e-9)))])
    some = -np.expm1(none[first[1:]] - none[first[:-1]])
    top = np.zeros(len(count))
    if len(marginal):
        top[count > 0] = np.maximum.reduceat(marginal, first[:-1][count > 0])
    return np.stack([_logit(some), _logit(top), np.log1p(count), np.ones(len(count))], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (weight * (y - p)) - penalty * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, text: str = "text", per_class: int = PER_CLASS) -> Model | None:
    """Model learned from labelled rows outside the held-out fold."""
    context = docs.sparkSession.sparkContext
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 2))
             .groupBy(F.col("doc_id").alias("id")).agg(F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    rows = docs.where(fold("doc_id") != 2).select(
        F.col("doc_id").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # labels grow with the documents: the same join at every size, never a broadcast
    counts = cell_counts(rows.join(known.hint("merge"), "id"), "text", "toxic", 2, ORDERS, BITS, True)
    if counts[0, -1] == 0 or counts[1, -1] == 0:
        return None
    others = context.broadcast([_evidence(counts, without=k) for k in (0, 1)])
    unit = F.pmod(F.xxhash64(F.lit(13), "id"), F.lit(1 << 30)) / float(1 << 30)
    rate = [min(1.0, per_class / counts[k, -1]) for k in (0, 1)]
    chosen = known.where(unit < F.when(F.col("toxic") == 1, F.lit(rate[1])).otherwise(F.lit(rate[0])))
    # about 2 * per_class ids, by the sampling rates above: small whatever the input
    sample = _sampled(rows.join(F.broadcast(chosen), "id"), others).toPandas().sort_values("id", kind="stable")
    y = sample["toxic"].to_numpy(dtype=np.int64)
    value = [np.asarray(v, dtype=np.int64) for v in sample["bins"]]
    lengths = np.array([len(v) for v in value], dtype=np.int64)
    flat = np.concatenate(value) if value else np.zeros(0, dtype=np.int64)
    tags = np.concatenate([_tags(v, k) for v, k in zip(value, y)]) if value else flat
    weight = np.where(y == 1, 1 / rate[1], 1 / rate[0])  # undoes the two sampling rates
    weights, trans = fit(flat, tags, lengths, BINS, weight / weight.mean())
    first = np.concatenate([[0], np.cumsum(lengths)])
    x = _any(_marginals(flat, lengths, weights, trans), first, lengths)
    scale = _logistic(x, y.astype(float), weight)
    return Model(_evidence(counts), weights, trans, scale)


def tag(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Documents plus score and toxic_spans (code-point ranges, flattened)."""
    if model is None:
        return docs.drop("score", "toxic_spans").withColumns(
            {"score": F.lit(0.0), "toxic_spans": F.array().cast("array<int>")})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS numbers
    return add_columns(docs, text, "score double, toxic_spans array<int>", lambda texts: shared.value.score(texts))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = train(clean(docs, "doc_id", "text"), clean(labels, "doc_id", "toxic"))
    rows = clean(docs, "doc_id", "text").withColumn("held_out", fold("doc_id") == 2)
    return tag(rows, model).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
