"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

1. One pass over the whole texts turns each document into a short vector of statistics: logarithms of counts,
   square roots of shares (``MEASURES``). It is written; texts are not read again.
2. The vectors of labelled training rows are summed up per class and inner fold (count, sum, outer products) in
   the tasks and added by Spark, so every labelled row counts and only sums of fixed size reach the driver.
3. Each class has a mean and a covariance that is shrunk towards the pooled one and towards a sphere. How far
   is chosen by cross-validated log loss over the inner folds of the training rows; held-out rows play no part.
4. A score is the logistic value of the difference of the two log densities and log shares. The distances use
   inverse Cholesky factors computed once with the model.

Labels, language, source and id are no inputs; the id only places a row in a fold or joins it to its label.

Defined cases: a null text is an empty one, whose statistics are those of no words; a null id is never a training
row; an id with labels of both kinds is left out of training, one with several equal labels counts once per
document row; null labels are ignored; without training rows of both kinds every score is the share of label 1
(0.5 without any); repeated documents are scored once per row; an empty table gives an empty result; only
``doc_id``, ``text`` and ``quality`` are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from namekin.llm.words import _IS_SPACE, hash_words, slices, text_bytes, word_bounds
from namekin.operators.skew import join_lookup
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
#: Shares of the pooled covariance and of the sphere among which cross-validation chooses.
POOLED, ROUND = (0.0, 0.1, 0.3, 0.5, 0.8), (0.003, 0.01, 0.03, 0.1, 0.3)
#: Least variance of a standardised direction.
FLOOR = 1e-6

MEASURES = (
    "words", "word_length", "distinct_words", "most_frequent_word", "repeats_previous", "upper_case", "symbols",
    "calls", "stops", "digits", "words_without_letter", "line_length", "sentence_length",
)
MEASURE_SCHEMA = "doc_id long, measures array<double>"


def _bytes_of(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_UPPER, _LOWER = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _bytes_of("abcdefghijklmnopqrstuvwxyz")
_LETTER = _UPPER | _LOWER | (np.arange(256) >= 0x80)
_FOLLOWING = (np.arange(256) & 0xC0) == 0x80


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offset : next offset]``."""
    out = np.zeros(len(offsets) - 1)
    filled = np.flatnonzero(offsets[1:] > offsets[:-1])
    if len(filled):
        out[filled] = np.add.reduceat(values, offsets[:-1][filled], dtype=np.int64)
    return out


def measure(texts: pa.Array) -> np.ndarray:
    """The statistics of every text, one row each, in the order of ``MEASURES``."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_bounds(data, offsets)
    hashed = hash_words(data, starts, ends, lower=True)
    n_rows, n = len(offsets) - 1, np.diff(before).astype(float)
    words = np.maximum(n, 1)
    count = lambda table: _per_text(table[data], offsets)

    row = np.repeat(np.arange(n_rows), np.diff(before))
    order = np.lexsort((hashed, row))
    of, kinds = row[order], hashed[order]
    first = np.ones(len(kinds), bool)
    first[1:] = (of[1:] != of[:-1]) | (kinds[1:] != kinds[:-1])
    distinct, most = np.bincount(of[first], minlength=n_rows), np.zeros(n_rows)
    np.maximum.at(most, of[first], np.diff(np.append(np.flatnonzero(first), len(kinds))))
    again = np.zeros(len(hashed), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (row[1:] == row[:-1])
    bare = np.zeros(0, bool)
    if len(starts):  # what follows a word up to the next one holds no letters
        bare = ~np.maximum.reduceat(_LETTER[data], starts)

    characters = np.maximum(count(~_FOLLOWING & ~_IS_SPACE), 1)
    upper, lower = count(_UPPER), count(_LOWER)
    share = lambda part, of_all: np.sqrt(part / np.maximum(of_all, 1))
    return np.stack([
        np.log1p(n), np.log1p(characters / words), share(distinct, words), share(most, words),
        share(_per_text(again, before), words), share(upper, upper + lower),
        share(count(_bytes_of("#*$%&|<>")), characters), share(count(_bytes_of("!?")), characters),
        share(count(_bytes_of(".,;:")), characters), share(count(_bytes_of("0123456789")), characters),
        share(_per_text(bare, before), words), np.log(words / (count(_bytes_of("\n")) + 1)),
        np.log(words / (count(_bytes_of(".!?")) + 1)),
    ], axis=1)


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, measures)`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                values = measure(batch.column("text"))
                ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "measures"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, MEASURE_SCHEMA)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def training_rows(vectors: DataFrame, labels: DataFrame) -> DataFrame:
    """``(quality, fold, measures)`` of the labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
    known = known.filter("quality = high").drop("high")
    joined = join_lookup(vectors.filter(F.col("doc_id").isNotNull()), known, ["doc_id"])
    return joined.select("quality", fold(F.col("doc_id")).cast("int").alias("fold"), "measures")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("measures").flatten().to_numpy().reshape(batch.num_rows, -1)


def moments(training: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """By class and fold: the sums of ``x x'`` where x is a row's measures after a 1."""
    size = len(MEASURES) + 1

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), _matrix(batch)]) if batch.num_rows else np.zeros((0, size))
            of = [batch.column(c).to_numpy() for c in ("quality", "fold")]
            for key in {*zip(*(c.tolist() for c in of))}:
                some = x[(of[0] == key[0]) & (of[1] == key[1])]
                sums[key] = sums.get(key, 0) + some.T @ some
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array([k[i] for k in sums], pa.int32()) for i in (0, 1)),
                pa.array([s.ravel().tolist() for s in sums.values()], pa.list_(pa.float64())),
            ],
            names=["quality", "fold", "sums"],
        )

    parts = training.mapInArrow(add_up, "quality int, fold int, sums array<double>")
    cells = parts.select("quality", "fold", F.posexplode("sums").alias("cell", "value"))
    out: dict[tuple[int, int], np.ndarray] = {}
    for r in cells.groupBy("quality", "fold", "cell").agg(F.sum("value").alias("value")).collect():
        out.setdefault((r["quality"], r["fold"]), np.zeros(size * size))[r["cell"]] = r["value"]
    return {k: v.reshape(size, size) for k, v in out.items()}


@dataclass
class Model:
    """Means and inverse Cholesky factors of both classes in standardised measures."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    @classmethod
    def of(cls, sums: list[np.ndarray], pooled: float, sphere: float) -> "Model":
        """From the moments of class 0 and class 1, both with rows."""
        total = sums[0] + sums[1]
        n = total[0, 0]
        centre = total[0, 1:] / n
        scale = np.sqrt(np.maximum(np.diag(total)[1:] / n - centre**2, 0))
        scale = np.where(scale > 1e-9, scale, 1.0)
        means, spreads = [], []
        for s in sums:
            mean = s[0, 1:] / s[0, 0]
            means.append((mean - centre) / scale)
            spreads.append((s[1:, 1:] / s[0, 0] - np.outer(mean, mean)) / np.outer(scale, scale))
        together = (sums[0][0, 0] * spreads[0] + sums[1][0, 0] * spreads[1]) / n
        factors, constants = [], []
        for s, spread in zip(sums, spreads):
            shrunk = (1 - pooled) * spread + pooled * together
            shrunk = (1 - sphere) * shrunk + sphere * np.trace(shrunk) / len(shrunk) * np.eye(len(shrunk))
            lower = np.linalg.cholesky((shrunk + shrunk.T) / 2 + FLOOR * np.eye(len(shrunk)))
            factors.append(np.linalg.inv(lower))
            constants.append(np.log(s[0, 0] / n) - np.log(np.diag(lower)).sum())
        return cls(centre, scale, np.array(means), np.array(factors), np.array(constants))

    def difference(self, values: np.ndarray) -> np.ndarray:
        """Log density and log share of class 1 less those of class 0."""
        z = (values - self.centre) / self.scale
        log = [
            c - (((z - m) @ f.T) ** 2).sum(axis=1) / 2
            for m, f, c in zip(self.means, self.factors, self.constants)
        ]
        return log[1] - log[0]

    def score(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.difference(values), -700, 700)))


@dataclass
class Constant:
    """Stands in for a model where training rows of a class are missing."""

    value: float

    def score(self, values: np.ndarray) -> np.ndarray:
        return np.full(len(values), self.value)


def fit(vectors: DataFrame, labels: DataFrame) -> Model | Constant:
    """A model from all labelled rows outside the held-out fold; ``vectors`` should be a written table."""
    training = written(training_rows(vectors, labels), "labelled")
    found = moments(training)
    sums = [sum((s for (q, _), s in found.items() if q == c), np.zeros((len(MEASURES) + 1,) * 2)) for c in (0, 1)]
    counts = [s[0, 0] for s in sums]
    if not all(counts):
        return Constant(counts[1] / sum(counts) if sum(counts) else 0.5)
    grid = [(p, r) for p in POOLED for r in ROUND]
    models: dict[int, list[Model]] = {}
    for f in {f for _, f in found}:
        rest = [s - found.get((c, f), 0) for c, s in enumerate(sums)]
        if all(s[0, 0] > 0.5 for s in rest):
            models[f] = [Model.of(rest, *g) for g in grid]
    return Model.of(sums, *grid[_least_loss(training, models, len(grid))])


def _least_loss(training: DataFrame, models: dict[int, list[Model]], n: int) -> int:
    """The place in the grid with the smallest log loss over rows that a model was not fitted on."""
    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            of = batch.column("fold").to_numpy()
            for f, tried in models.items():
                some = batch.filter(pa.array(of == f))
                if some.num_rows:
                    values, sign = _matrix(some), 1 - 2 * some.column("quality").to_numpy()
                    total += [np.logaddexp(0, sign * m.difference(values)).sum() for m in tried]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n), pa.int32()), pa.array(total)], names=["place", "loss"]
        )

    rows = training.mapInArrow(losses, "place int, loss double").groupBy("place").agg(F.sum("loss").alias("loss"))
    return min(((round(r["loss"], 6), r["place"]) for r in rows.collect()), default=(0, n // 2))[1]


def score(vectors: DataFrame, model: Model | Constant) -> DataFrame:
    """``(doc_id, score)``, 0 to 1, higher where label 1 is likelier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(model.score(_matrix(batch)))], names=["doc_id", "score"]
                )

    return vectors.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, score)`` of all documents by a model fitted on the labels."""
    vectors = written(measured(docs), "measures")
    return score(vectors, fit(vectors, labels))
