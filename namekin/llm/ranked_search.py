"""Ranked search of documents for every item of a query table, by hashed max-sketches.

A term of a document has an impact: its weight times its saturated frequency. The impacts of a document
are folded into ``COORDINATES`` cells by a hash of the term, each cell keeping the maximum. The sum of the
cells that an item's terms point to is never below the document's score for the item, and for a batch of
documents and all items it is one matrix product. Documents are then scored exactly by falling bound,
until the bound is below the score of the last place held so far.

1. One pass over the texts counts, per document, its terms and the frequencies of the terms that occur in
   items; this forward index is written. Corpus counts are Spark aggregates of it.
2. Each task goes through its part of the index in batches, carrying the best documents of every item, and
   returns at most ``top`` rows an item. One window per item picks the final ranks among these.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so what is sent to the tasks is bounded however
many items there are; each block is held against all documents.

Defined cases: null, blank or symbol-only texts have no terms, are not counted and never found; an item
without terms has no rows; a repeated document or item is ranked once per row; a null id comes after the
others of its score; no documents or no items give no rows; only ``doc_id``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, Window, functions as F

from namekin.llm.words import plain_words, slices, text_bytes
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
COORDINATES = 256
#: Terms, repeats included, of the items that are held against the documents at once.
BLOCK_TERMS = 1 << 17
#: Documents whose bounds are looked up together, and documents scored exactly between two looks at the bound.
DOCS_TOGETHER, SCORED_TOGETHER = 2048, 64

INDEX_SCHEMA = "doc_id long, n long, terms array<int>, tf array<long>"
FOUND_SCHEMA = "query int, item_id long, doc_id long, score long"

# Separators become spaces, A-Z become a-z, everything else stays.
_TERM_BYTES = np.full(256, 0x20, np.uint8)
for _first, _last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _TERM_BYTES[_first : _last + 1] = np.arange(_first, _last + 1)
_TERM_BYTES[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms(texts: pa.Array) -> pa.ListArray:
    """The terms of every text; an empty string may stand before the first and after the last one."""
    data, offsets = text_bytes(texts)
    plain = _TERM_BYTES[data]
    strings = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(plain)
    )
    return pc.ascii_split_whitespace(strings)


def forward_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(doc_id, n, terms, tf)``: all terms of a document with repeats, and the places in ``vocabulary`` of
    those it holds with their frequencies, ascending."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.large_string())
        for whole in batches:
            for batch in slices(whole):
                words = terms(batch.column("text"))
                ends = words.offsets.to_numpy()
                values = words.values
                filled = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy(zero_copy_only=False) > 0)])
                n = filled[ends[1:]] - filled[ends[:-1]]
                place = pc.fill_null(pc.index_in(values, value_set=known), -1).to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                hit = place >= 0
                keys, tf = np.unique(row[hit] * len(vocabulary) + place[hit], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(batch.num_rows + 1) * len(vocabulary)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(x))
                    for x in ((keys % len(vocabulary)).astype(np.int32), tf.astype(np.int64))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), *lists], names=["doc_id", "n", "terms", "tf"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(index, INDEX_SCHEMA)


@dataclass
class Queries:
    """A block of items: per item its terms as places in the vocabulary, ascending, and their repeats."""

    item_ids: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    vocabulary: list[str]

    @classmethod
    def of(cls, rows: list[Row]) -> "Queries":
        vocabulary = sorted({t for r in rows for t in r["terms"]})
        place = {t: k for k, t in enumerate(vocabulary)}
        found = [np.unique([place[t] for t in r["terms"]], return_counts=True) for r in rows]
        return cls([r["item_id"] for r in rows], [t for t, _ in found], [n for _, n in found], vocabulary)

    def cells(self, coordinates: int) -> np.ndarray:
        """The cell of every term of the vocabulary."""
        return np.array([zlib.crc32(t.encode()) % coordinates for t in self.vocabulary], np.int64)

    def lookup(self, coordinates: int) -> np.ndarray:
        """Matrix of cells by items: how many of an item's terms point to a cell."""
        cells, out = self.cells(coordinates), np.zeros((coordinates, len(self.terms)))
        for k, (places, repeats) in enumerate(zip(self.terms, self.repeats)):
            np.add.at(out[:, k], cells[places], repeats)
        return out


@dataclass
class Corpus:
    """Counts over all documents: documents with terms, all terms, and the weight of each vocabulary term."""

    n_docs: int
    n_terms: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, places: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Impact of a term with frequency ``tf`` in a document of ``n`` terms, as 64-bit integers."""
        if int(n.max(initial=0)) * 25 * self.n_docs >= 1 << 63:
            share = np.array([25 * int(x) * self.n_docs // self.n_terms for x in n], np.int64)
        else:
            share = 25 * n * self.n_docs // self.n_terms
        return self.weights[places] * (1_000_000_000 * tf // (1000 * tf + 12 * (75 + share)))


def corpus_counts(index: DataFrame, vocabulary: list[str]) -> Corpus:
    """Aggregates over the whole index; collects one row per vocabulary term at most."""
    n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for place, n in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[place] = n
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]
    return Corpus(n_docs, n_terms, np.array(weights, np.int64))


def sketch(rows: np.ndarray, cells: np.ndarray, impacts: np.ndarray, n_rows: int, coordinates: int) -> np.ndarray:
    """Coordinatewise maxima of the impacts: one row per document."""
    out = np.zeros(n_rows * coordinates)
    np.maximum.at(out, rows * coordinates + cells, impacts)
    return out.reshape(n_rows, coordinates)


class Leaders:
    """The best documents of every item so far, by falling score, then by rising id (null last)."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.scores = [np.zeros(0, np.int64)] * n_items
        self.ids = [np.zeros(0, object)] * n_items

    def least(self, item: int) -> int:
        """A document with a smaller score cannot be among the best."""
        scores = self.scores[item]
        return int(scores[-1]) if len(scores) == self.top else 1

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[item], scores]), np.concatenate([self.ids[item], ids])
        null = np.array([i is None for i in ids], bool)
        number = np.array([0 if i is None else i for i in ids], np.int64)
        best = np.lexsort((number, null, -scores))[: self.top]
        best = best[scores[best] > 0]
        self.scores[item], self.ids[item] = scores[best], ids[best]


def _exact(keys, impacts, size, docs, places, repeats) -> np.ndarray:
    """Scores of some documents for one item; ``keys`` are ``document * size + place``, ascending."""
    if not len(keys):
        return np.zeros(len(docs), np.int64)
    wanted = docs[:, None] * size + places[None, :]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, impacts[at], 0) @ repeats


def best_documents(index: DataFrame, queries: Queries, corpus: Corpus, top: int, coordinates: int) -> DataFrame:
    """``(query, item_id, doc_id, score)``: the best ``top`` documents of each part of the index, per item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, lookup, size = queries.cells(coordinates), queries.lookup(coordinates), len(queries.vocabulary)
        leaders = Leaders(len(queries.terms), top)
        for whole in batches:
            for first in range(0, whole.num_rows, DOCS_TOGETHER):
                batch = whole.slice(first, DOCS_TOGETHER)
                lists = batch.column("terms")
                ends = lists.offsets.to_numpy()
                places = lists.flatten().to_numpy().astype(np.int64)
                if not len(places):
                    continue
                rows = np.repeat(np.arange(batch.num_rows), np.diff(ends))
                tf = batch.column("tf").flatten().to_numpy()
                impacts = corpus.impacts(batch.column("n").to_numpy()[rows], places, tf)
                keys = rows * size + places
                folded = sketch(rows, cells[places], impacts, batch.num_rows, coordinates)
                bounds = (folded @ lookup) * (1 + 1e-9)  # sums of floats stay bounds
                ids = np.array(batch.column("doc_id").to_pylist(), object)
                for item in np.flatnonzero(bounds.max(axis=0) >= [leaders.least(k) for k in range(lookup.shape[1])]):
                    near = np.flatnonzero(bounds[:, item] >= leaders.least(item))
                    near = near[np.argsort(-bounds[near, item], kind="stable")]
                    for k in range(0, len(near), SCORED_TOGETHER):
                        some = near[k : k + SCORED_TOGETHER]
                        some = some[bounds[some, item] >= leaders.least(item)]
                        if not len(some):
                            break
                        scores = _exact(keys, impacts, size, some, queries.terms[item], queries.repeats[item])
                        leaders.add(item, scores, ids[some])
        counts = [len(x) for x in leaders.scores]
        which = np.repeat(np.arange(len(counts)), counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(which, pa.int32()), pa.array([queries.item_ids[k] for k in which], pa.int64()),
                pa.array([i for x in leaders.ids for i in x], pa.int64()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *leaders.scores]), pa.int64()),
            ],
            names=["query", "item_id", "doc_id", "score"],
        )

    return index.mapInArrow(search, FOUND_SCHEMA)


def _ranked(docs: DataFrame, queries: Queries, top: int, coordinates: int) -> DataFrame:
    index = written(forward_index(docs, queries.vocabulary), "forward-index")
    corpus = corpus_counts(index, queries.vocabulary)
    found = best_documents(index, queries, corpus, top, coordinates)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, coordinates: int = COORDINATES, block_terms: int = BLOCK_TERMS
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``top`` documents of every item with a score above 0."""
    spark = docs.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), plain_words(F.col("text")).alias("terms"))
    asked = written(asked.filter(F.size("terms") > 0), "items")
    n_blocks = math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms)
    block = F.pmod(F.xxhash64("item_id", "terms"), F.lit(max(n_blocks, 1)))
    parts = []
    for k in range(n_blocks):
        rows = asked.filter(block == k).collect()
        if rows:
            parts.append(_ranked(docs, Queries.of(rows), top, coordinates))
            if n_blocks > 1:
                parts[-1] = written(parts[-1], "ranked")
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
