"""Removal of repeated passages: runs of 20 words that stand earlier in the corpus.

Fixed-block anchors: every run of 20 words holds a whole block of 10 words that starts at a multiple of
10 in its document. The blocks of all documents form the index, every rolling window of 10 words probes
it, and hits are extended to full runs.

1. Documents are packed, in id order, into groups of about two megabytes of text, written once.
2. Each group sends its distinct rolling-window hashes, and which of them are blocks, to the part of
   the hash range they fall in; the part answers with one bit per hash: held by a block and seen twice.
3. Windows of 20 words around hits are the candidates. Each group sends the first place of every
   distinct candidate to its hash part, which answers with one bit: first place of all.
4. Each group removes the words of candidates that are not the first, which yields maximal repeats.

A passage that many documents share is sent once per group, so no part gets more than one entry per
group for it. Hashes travel as arrays, as a row per window would cost far more. Anchors are compared
by at least 32 bits beyond the part number, which only adds candidates; runs are compared by 64-bit
hashes of 64-bit word hashes.

Defined cases: null or blank texts have no words and pass unchanged; equal ids count as earlier in the
order they were packed; null ids come last; repeated rows are repeats of the first one; an empty table
gives an empty result; all columns are carried along, whatever their names.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from namekin.llm.words import hash_windows, hash_words, slices, text_bytes, within_texts, word_bounds
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUN = 20
BLOCK = 10
#: Windows per part of the hash range; a part is handled by one task at a time.
PART_WINDOWS = 2_000_000
_LAST = np.iinfo(np.int64).max


# Arrays as compact binary values.

def packed(values: np.ndarray) -> bytes:
    """Unsigned integers as byte planes, so that planes with few bits set shrink when compressed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def unpacked(data: bytes, n: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of sorted values."""
    return np.diff(values, prepend=values.dtype.type(0))


def _sums(steps: np.ndarray) -> np.ndarray:
    return np.cumsum(steps, dtype=steps.dtype)


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


# Groups of documents.

def grouped(docs: DataFrame) -> DataFrame:
    """``(gid, n_words, body)``: groups of rows as compressed Arrow batches, sorted by id."""

    def pack(batches):
        gid = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in slices(whole):
                ids = batch.column("doc_id").cast(pa.int64())
                order = np.argsort(ids.fill_null(_LAST).to_numpy(), kind="stable")
                batch = batch.take(pa.array(order))
                _, _, before = word_bounds(*text_bytes(batch.column("text")))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(
                    sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
                ) as out:
                    out.write_batch(batch)
                yield pa.RecordBatch.from_pydict({
                    "gid": pa.array([gid], pa.int64()),
                    "n_words": pa.array([int(before[-1])], pa.int64()),
                    "body": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
                })
                gid += 1

    return docs.mapInArrow(pack, "gid long, n_words long, body binary")


class Group:
    """Window hashes of one packed group."""

    def __init__(self, body: bytes):
        self.rows = pa.ipc.open_stream(body).read_next_batch()
        self.data, offsets = text_bytes(self.rows.column("text"))
        self.starts, self.ends, self.before = word_bounds(self.data, offsets)
        self.words = hash_words(self.data, self.starts, self.ends)
        h = hash_windows(self.words, BLOCK)
        inside = within_texts(self.before, BLOCK)
        counts = np.diff(self.before)
        long = np.repeat(counts >= RUN, counts)[: len(h)]
        self.at = np.flatnonzero(inside & long)  # places of the rolling windows
        self.values, self.inverse, self.counts = np.unique(
            h[self.at], return_inverse=True, return_counts=True
        )
        first = np.repeat(self.before[:-1], counts)
        blocks = (self.at - first[self.at]) % BLOCK == 0
        self.is_block = np.zeros(len(self.values), bool)
        self.is_block[self.inverse[blocks]] = True

    def candidates(self, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Runs of 20 words around hits: places, distinct hashes, first place and index of each."""
        touched = np.zeros(len(self.words) + 1, np.int64)
        touched[self.at[hit[self.inverse]] + 1] = 1
        np.cumsum(touched, out=touched)
        n = max(0, len(self.words) - RUN + 1)
        places = np.arange(n)
        near = touched[places + RUN - BLOCK + 1] > touched[places]
        places = places[near & within_texts(self.before, RUN)]
        values, first, inverse = np.unique(
            hash_windows(self.words, RUN)[places], return_index=True, return_inverse=True
        )
        return places, values, first, inverse

    def ids(self) -> np.ndarray:
        return self.rows.column("doc_id").cast(pa.int64()).fill_null(_LAST).to_numpy()


def _part_edges(values: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the hash range begins in sorted values, with the end."""
    edges = np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edges), [len(values)]]).astype(np.int64)


def _short(values: np.ndarray, part: int, parts: int) -> np.ndarray:
    """The 32 bits of the hashes after those that all values of the part share."""
    shift = np.uint64(32 - int(math.log2(parts)))
    low = np.uint64((part << 64) // parts)
    return ((values - low) >> shift).astype(np.uint32)


PROBES = "part int, gid long, n int, hashes binary, many binary, block binary"
ANSWER = "gid long, part int, n int, bits binary"


def _probes(parts: int):
    def run(batches):
        for batch in batches:
            for gid, body in zip(batch.column("gid").to_pylist(), batch.column("body")):
                group = Group(body.as_buffer())
                edges = _part_edges(group.values, parts)
                rows = []
                for part in np.flatnonzero(np.diff(edges)):
                    span = slice(edges[part], edges[part + 1])
                    short = _short(group.values[span], int(part), parts)
                    rows.append((
                        int(part), gid, len(short), packed(_steps(short)),
                        bits(group.counts[span] > 1), bits(group.is_block[span]),
                    ))
                yield _batch(rows, PROBES)

    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields]
    )


def _answers(table: pa.Table, answer: np.ndarray) -> pa.Table:
    """One row of bits per sender; senders without any are left out."""
    rows, at = [], 0
    for gid, part, n in zip(*[table.column(c).to_pylist() for c in ("gid", "part", "n")]):
        mine = answer[at : at + n]
        at += n
        if mine.any():
            rows.append((gid, part, n, bits(mine)))
    return pa.Table.from_batches([_batch(rows, ANSWER)])


def _find_hits(table: pa.Table) -> pa.Table:
    """Which probes are held by a block somewhere and stand in the corpus at least twice."""
    lists = [table.column(c).to_pylist() for c in ("n", "hashes", "many", "block")]
    short = np.concatenate([_sums(unpacked(h, n, "u4")) for n, h, _, _ in zip(*lists)])
    many = np.concatenate([flags(m, n) for n, _, m, _ in zip(*lists)])
    block = np.concatenate([flags(b, n) for n, _, _, b in zip(*lists)])
    values, inverse, seen = np.unique(short, return_inverse=True, return_counts=True)
    twice = seen > 1
    twice[inverse[many]] = True
    held = np.zeros(len(values), bool)
    held[inverse[block]] = True
    return _answers(table, (twice & held)[inverse])


FIRSTS = "part int, gid long, n int, hashes binary, base long, ids binary, width int, places binary"


def _hit_flags(group: Group, answers: list | None, parts: int) -> np.ndarray:
    hit = np.zeros(len(group.values), bool)
    edges = _part_edges(group.values, parts)
    for a in answers or []:
        hit[edges[a["part"]] : edges[a["part"] + 1]] = flags(a["bits"], a["n"])
    return hit


def _first_places(parts: int):
    def run(batches):
        for batch in batches:
            for gid, body, hits in zip(
                batch.column("gid").to_pylist(), batch.column("body"), batch.column("hits").to_pylist()
            ):
                group = Group(body.as_buffer())
                places, values, first, _ = group.candidates(_hit_flags(group, hits, parts))
                places = places[first]
                doc = np.searchsorted(group.before, places, "right") - 1
                ids, start = group.ids()[doc], (places - group.before[doc]).astype(np.uint32)
                edges = _part_edges(values, parts)
                rows = []
                for part in np.flatnonzero(np.diff(edges)):
                    span = slice(edges[part], edges[part + 1])
                    base = int(ids[span].min())
                    offset = ids[span].astype(np.uint64) - np.uint64(base % (1 << 64))
                    kind = np.uint32 if offset.max() < 1 << 32 else np.uint64
                    rows.append((
                        int(part), gid, edges[part + 1] - edges[part], packed(_steps(values[span])),
                        base, packed(offset.astype(kind)), np.dtype(kind).itemsize, packed(start[span]),
                    ))
                yield _batch(rows, FIRSTS)

    return run


def _find_firsts(table: pa.Table) -> pa.Table:
    """Which places are the first of their hash."""
    names = ("n", "hashes", "base", "ids", "width", "places", "gid")
    rows = list(zip(*[table.column(c).to_pylist() for c in names]))
    values = np.concatenate([_sums(unpacked(h, n, "u8")) for n, h, *_ in rows])
    ids = np.concatenate([
        (unpacked(o, n, f"u{w}").astype(np.uint64) + np.uint64(b % (1 << 64))).view(np.int64)
        for n, _, b, o, w, *_ in rows
    ])
    start = np.concatenate([unpacked(p, n, "u4") for n, *_, p, _ in rows])
    gid = np.concatenate([np.full(n, g, np.int64) for n, *_, g in rows])
    order = np.lexsort((gid, start, ids, values))
    ranked = values[order]
    first = np.ones(len(order), bool)
    first[1:] = ranked[1:] != ranked[:-1]
    answer = np.zeros(len(order), bool)
    answer[order[first]] = True
    return _answers(table, answer)


def _clean(parts: int, columns: list[str]):
    def run(batches):
        for batch in batches:
            for body, hits, firsts in zip(
                batch.column("body"), batch.column("hits").to_pylist(), batch.column("firsts").to_pylist()
            ):
                group = Group(body.as_buffer())
                places, values, first, inverse = group.candidates(_hit_flags(group, hits, parts))
                keeps = np.zeros(len(values), bool)
                edges = _part_edges(values, parts)
                for a in firsts or []:
                    keeps[edges[a["part"]] : edges[a["part"] + 1]] = flags(a["bits"], a["n"])
                later = ~keeps[inverse]
                later |= np.arange(len(places)) != first[inverse]
                change = np.zeros(len(group.words) + 1, np.int64)
                np.add.at(change, places[later], 1)
                np.add.at(change, places[later] + RUN, -1)
                removed = np.cumsum(change[:-1]) > 0
                counts = np.diff(group.before)
                total = np.concatenate([[0], np.cumsum(removed)])
                n_removed = total[group.before[1:]] - total[group.before[:-1]]
                texts = []
                for k, text in enumerate(group.rows.column("text").to_pylist()):
                    words = (text or "").encode().split()
                    if n_removed[k]:
                        gone = removed[group.before[k] : group.before[k + 1]]
                        words = [w for w, g in zip(words, gone) if not g]
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [group.rows.column(k) for k in range(len(columns))]
                    + [pa.array(counts, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())],
                    names=[f"c{k}" for k in range(len(columns))] + ["n_words", "n_removed", "kept_text"],
                )

    return run


def without_repeats(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns of ``docs``), ``n_words``, ``n_removed`` and ``kept_text``, the
    kept words joined by one space."""
    groups = written(grouped(docs), "groups")
    total = groups.agg(F.sum("n_words")).first()[0] or 0
    parts = max(1, math.ceil(total / PART_WINDOWS))

    def answers(sent: DataFrame, answer, name: str) -> DataFrame:
        replies = written(sent.groupBy("part").applyInArrow(answer, ANSWER), name)
        mine = F.collect_list(F.struct("part", "n", "bits"))  # a group's own bits: as bounded as it is
        return replies.groupBy("gid").agg(mine.alias(name))

    probes = groups.select("gid", "body").mapInArrow(_probes(parts), PROBES)
    hits = answers(probes, _find_hits, "hits")
    hit_groups = groups.select("gid", "body").join(hits, "gid")
    firsts = answers(hit_groups.mapInArrow(_first_places(parts), FIRSTS), _find_firsts, "firsts")
    final = groups.select("gid", "body").join(hits, "gid", "left").join(firsts, "gid", "left")
    columns = docs.columns
    kinds = [f"c{k} {docs.schema[c].dataType.simpleString()}" for k, c in enumerate(columns)]
    schema = ", ".join([*kinds, "n_words long", "n_removed long", "kept_text string"])
    rows = final.select("body", "hits", "firsts").mapInArrow(_clean(parts, columns), schema)
    return rows.select(
        F.struct(*[F.col(f"c{k}").alias(c) for k, c in enumerate(columns)]).alias("row"),
        "n_words", "n_removed", "kept_text",
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents with repeated runs taken out of ``text`` and ``n_chars`` brought up to date.

    Texts without repeats stay as they are; documents of which nothing is left are dropped.
    """
    found = without_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    left = found.filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    return left.select(*[
        (F.when(F.col("n_removed") > 0, new[c]).otherwise(F.col(f"row.`{c}`")) if c in new else F.col(f"row.`{c}`")).alias(c)
        for c in docs.columns
    ])
