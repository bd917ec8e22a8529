"""Toxic passages as maximal scoring segments.

1. Features of a word are the word and its first 3 to 6 characters. Their log-odds between toxic and
   other labelled documents use document counts and a Dirichlet prior in proportion to the feature's
   overall share. Features whose lower bound is high enter the model with that bound, features whose
   upper bound is low as harmless; what is between says nothing.
2. A word scores its most specific feature in the model (the word, then ever shorter beginnings);
   harmless and unknown words score a small loss. One linear scan (Ruzzo and Tompa) finds all maximal
   segments of a text.
3. Segments are calibrated by extreme values: with losses on average, the best segment of a clean text
   of n words exceeds x with about ``1 - exp(-K n exp(-lambda x))``. The evidence of a document is
   ``-ln P`` of its segments together; a logistic curve over its
   logarithm, fitted on the training labels, turns it into the score.

The model is bounded: every feature must stand in a stated share of the toxic training documents. It
is fitted on at most ``TRAIN_ROWS`` labelled rows, the smallest by a hash of the id.

Defined cases: a null or blank text has no segment and gets the score of no evidence; without labels of
both kinds every score is 0; null labels and ids are not learned from; a null id counts as not held
out; rows are scored one by one, so repeated rows get equal scores; only ``doc_id, text`` of the
documents and ``doc_id, toxic`` of the labels are read.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from namekin.llm.words import hash_words, letter_bounds, mixed, slices, text_bytes
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN_ROWS = 50_000
FOLDS, HELD_OUT = 3, 1
PREFIXES = (3, 4, 5, 6)
#: A feature must stand in this share of the toxic training documents, and in so many of them.
MIN_SHARE, MIN_DOCS = 0.005, 3
PRIOR = 10.0
MIN_Z = 2.8
#: Log-odds that a lower bound must reach, and an upper bound stay below.
MIN_WEIGHT = 2.0
LOSS = 0.5
THRESHOLD = 0.7


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


# Features.

def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes (words x features; 0 if the word is shorter) and the words before each text."""
    data, offsets = text_bytes(texts)
    starts, ends, before = letter_bounds(data, offsets)
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint64)
    if not len(starts):
        return out, before
    out[:, 0] = hash_words(data, starts, ends, lower=True)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # first bytes of characters
    heads = np.append(heads, len(data))
    char = np.searchsorted(heads, starts)
    for k, size in enumerate(PREFIXES):
        stop = heads[np.minimum(char + size, len(heads) - 1)]
        whole = stop < ends
        hashed = hash_words(data, starts, np.minimum(stop, ends), lower=True)
        out[whole, 1 + k] = mixed(hashed[whole] + np.uint64(size))
    return out, before


def _document_features(batch: pa.RecordBatch):
    """Distinct features of each document."""
    found, before = features(batch.column("text"))
    for first, last in zip(before[:-1], before[1:]):
        values = np.unique(found[first:last])
        yield values[values != 0]


def _count(batches, only: np.ndarray | None):
    """``(feature, toxic, other)``: documents of each kind that hold the feature, per batch."""
    for whole in batches:
        for batch in slices(whole):
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            kinds = {1: [], 0: []}
            for values, kind in zip(_document_features(batch), toxic):
                if only is not None:
                    values = values[np.isin(values, only, assume_unique=True)]
                kinds[int(kind)].append(values)
            both = [np.concatenate([np.zeros(0, np.uint64), *kinds[k]]) for k in (1, 0)]
            values, inverse = np.unique(np.concatenate(both), return_inverse=True)
            n_toxic = np.bincount(inverse[: len(both[0])], minlength=len(values))
            n_other = np.bincount(inverse[len(both[0]) :], minlength=len(values))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(n_toxic, pa.int64()), pa.array(n_other, pa.int64())],
                names=["feature", "toxic", "other"],
            )


def feature_counts(training: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    counted = training.mapInArrow(lambda b: _count(b, only), "feature long, toxic long, other long")
    return counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


# Model.

@dataclass
class Model:
    """Scores of features (sorted by hash), and the calibration."""

    values: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    rate: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    intercept: float = -math.inf

    def word_scores(self, found: np.ndarray) -> np.ndarray:
        scores = np.full(len(found), -LOSS)
        if len(self.values):
            maybe = np.zeros(1 << 20, bool)
            maybe[(self.values >> np.uint64(44)).astype(np.int64)] = True
            for k in (*range(1, found.shape[1]), 0):  # longer beginnings overrule shorter ones
                column = found[:, k]
                rows = np.flatnonzero(maybe[(column >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.values, column[rows]), len(self.values) - 1)
                same = self.values[at] == column[rows]
                scores[rows[same]] = self.weights[at[same]]
        return scores

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        """``-ln P`` of the best r segments together, for the r that makes it largest.

        The sum T of r normalised scores exceeds its value by chance with about
        ``exp(-T) T**(r-1) / (r! (r-1)!)`` (Karlin and Altschul).
        """
        best, total = 0.0, 0.0
        for r, score in enumerate(sorted((s for _, _, s in segments), reverse=True), 1):
            total += self.rate * score - math.log(max(self.k * n, 1e-12))
            if total <= 0:
                break
            value = total - (r - 1) * math.log(total) + math.lgamma(r + 1) + math.lgamma(r)
            best = max(best, value)
        return best

    def score(self, evidence: float) -> float:
        if self.intercept == -math.inf:
            return 0.0
        x = self.slope * math.log1p(evidence) + self.intercept
        return 1 / (1 + math.exp(-min(max(x, -50.0), 50.0)))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, end, score)``, in linear time.

    Only positive places are visited; the losses between two of them are summed at once.
    """
    stack = []  # first, end, total before it, total with it
    total, at = 0.0, 0
    sums = None
    for place in np.flatnonzero(scores > 0).tolist():
        if sums is None:
            sums = np.concatenate([[0.0], np.cumsum(scores)])
        total = sums[place]
        first, low, high = place, total, sums[place + 1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= low:
                j -= 1
            if j < 0 or stack[j][3] >= high:
                stack.append((first, place + 1, low, high))
                break
            first, low = stack[j][0], stack[j][2]
            del stack[j:]
    return [(a, b, high - low) for a, b, low, high in stack]


def _log_odds(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int):
    prior = 0.5 + PRIOR * (toxic + other) / (n_toxic + n_other)
    a, b = toxic + prior, other + prior
    delta = np.log(a / (n_toxic + PRIOR + 1 - a)) - np.log(b / (n_other + PRIOR + 1 - b))
    return delta, np.sqrt(1 / a + 1 / b)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Labelled texts outside the held-out fold, ``(text, toxic)``, one row per different text."""
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("_id")) != HELD_OUT)
    )
    known = known.orderBy(F.xxhash64("_id"), "_id", "toxic").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_id"))
    return joined.select("text", "toxic").filter(F.col("text").isNotNull()).dropDuplicates(["text", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    training = written(training_rows(docs, labels, rows), "training")
    sizes = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Model()
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * n_toxic))
    # At most (features per document) / MIN_SHARE candidates, whatever the size of the corpus.
    common = feature_counts(training.filter("toxic = 1")).filter(F.col("toxic") >= least)
    only = np.sort(np.array([r["feature"] for r in common.select("feature").collect()], np.int64).view(np.uint64))
    counts = feature_counts(training, only).toPandas()
    toxic, other = counts["toxic"].to_numpy(float), counts["other"].to_numpy(float)
    delta, spread = _log_odds(toxic, other, n_toxic, n_other)
    good = (delta / spread >= MIN_Z) & (delta - spread >= MIN_WEIGHT)
    known = good | (delta + spread < MIN_WEIGHT)
    values = counts["feature"].to_numpy(np.int64).view(np.uint64)[known]
    order = np.argsort(values)
    model = Model(values[order], np.where(good, delta - spread, -LOSS)[known][order])
    if not good.any():
        return model
    return _calibrated(model, training)


def _calibrated(model: Model, training: DataFrame) -> Model:
    def scored(batches):
        for whole in batches:
            for batch in slices(whole):
                found, before = features(batch.column("text"))
                scores = model.word_scores(found)
                rows = [segments(scores[a:b]) for a, b in zip(before[:-1], before[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("toxic"), pa.array(np.diff(before), pa.int64()),
                        pa.array([[s for _, _, s in r] for r in rows], pa.list_(pa.float64())),
                        pa.array([int((scores[a:b] > 0).sum()) for a, b in zip(before[:-1], before[1:])], pa.int64()),
                    ],
                    names=["toxic", "n", "segments", "n_positive"],
                )

    schema = "toxic int, n long, segments array<double>, n_positive long"
    table = training.mapInArrow(scored, schema).toPandas()  # at most TRAIN_ROWS rows
    clean = table[table["toxic"] == 0]
    words = int(clean["n"].sum()) + 1
    share = (int(clean["n_positive"].sum()) + 1) / words
    gain = float(np.median(model.weights[model.weights > 0]))
    # lambda: the positive root of  share * exp(gain x) + (1 - share) * exp(-LOSS x) = 1
    low, high = 1e-6, 50.0
    for _ in range(100):
        mid = (low + high) / 2
        value = share * math.exp(min(gain * mid, 700)) + (1 - share) * math.exp(-LOSS * mid)
        low, high = (mid, high) if value < 1 else (low, mid)
    model.rate = low
    seen = sum(len(s) for s in clean["segments"]) + 1
    model.k = seen / words * math.exp(min(model.rate * gain, 700))
    x = np.array([
        model.evidence([(0, 0, s) for s in row], n) for row, n in zip(table["segments"], table["n"])
    ])
    model.slope, model.intercept = _logistic(np.log1p(x), table["toxic"].to_numpy(float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept with a weak pull towards 0, by Newton steps."""
    a, b = 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + 1e-2 * a, (p - y).sum() + 1e-2 * b])
        h = np.array([[(w * x * x).sum() + 1e-2, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, n_segments, passages)``: passages are the significant segments, as structs of
    first word, end and score."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole):
                found, before = features(batch.column("text"))
                word_scores = model.word_scores(found)
                scores, kept = [], []
                for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
                    rows = segments(word_scores[a:b])
                    scores.append(model.score(model.evidence(rows, b - a)))
                    kept.append([
                        {"first": f, "end": e, "score": s} for f, e, s in rows
                        if model.evidence([(f, e, s)], b - a) > 0
                    ])
                kind = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(scores, pa.float64()),
                        pa.array([len(k) for k in kept], pa.int64()), pa.array(kept, pa.list_(kind)),
                    ],
                    names=["doc_id", "score", "n_segments", "passages"],
                )

    schema = "doc_id long, score double, n_segments long, passages array<struct<first:long,end:long,score:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
