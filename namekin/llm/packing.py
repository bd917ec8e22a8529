"""Token ids packed into rows of a fixed length.

Documents are encoded, closed by an end mark and cut losslessly into pieces of at most one row. Each task
packs a bounded buffer of pieces by best-fit decreasing: the fullest open row that still has room is
found in a segment tree over free places. A pack holds one row of the id matrix, padded with the end
mark, the cumulative lengths of its segments, the position of every token within its segment, and where
each segment comes from.

Defined cases: a null or blank text is one end mark; a null id is carried along; equal ids are packed
separately; an empty table gives no packs; only ``doc_id`` and ``text`` are read. Pack numbers are
unique and depend on how the input is divided among tasks.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F

from namekin.llm import tokenizers
from namekin.llm.words import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 2048
#: Tokens a task holds before it packs them; rows left open then stay short.
BUFFER_TOKENS = 8_000_000

SCHEMA = (
    "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
    "doc_ids array<long>, doc_starts array<long>"
)


class FreePlaces:
    """Counts of open rows by free places, with search for the least count of places that suffices."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.tree = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, places: int, row: int) -> None:
        self.rows[places].append(row)
        node = self.size + places
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, needed: int) -> tuple[int, int] | None:
        """``(row, places)`` of a row with the fewest places that are at least ``needed``."""
        node = self.size + needed
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        places = node - self.size
        row = self.rows[places].pop()
        while node:
            self.tree[node] -= 1
            node >>= 1
        return row, places


def best_fit(sizes: list[int], length: int = LENGTH) -> list[list[int]]:
    """Rows as lists of piece numbers; pieces are placed from the longest to the shortest."""
    rows: list[list[int]] = []
    free = FreePlaces(length)
    for piece in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        size = sizes[piece]
        found = free.take(size)
        if found is None:
            rows.append([])
            found = len(rows) - 1, length
        row, places = found
        rows[row].append(piece)
        if places > size:
            free.put(places - size, row)
    return rows


def pack(
    docs: DataFrame, length: int = LENGTH, buffer_tokens: int = BUFFER_TOKENS,
    folder: str = tokenizers.FOLDER, vocabulary: str = tokenizers.BYTE_BPE,
) -> DataFrame:
    """Packs of ``docs``; ids and positions are little-endian, 2 bytes wide if all ids fit, else 4.

    ``doc_starts`` holds the place of a segment's first token in its document.
    """
    data = tokenizers.vocabulary(vocabulary, folder)
    end = tokenizers.end_mark(data)
    kind = np.dtype("<u2") if end < 1 << 16 and length <= 1 << 16 else np.dtype("<u4")

    def flush(pieces, number):
        out = {name.split()[0]: [] for name in SCHEMA.split(", ")}
        for row in best_fit([len(p[2]) for p in pieces], length):
            ids = np.full(length, end, kind)
            positions = np.zeros(length, kind)
            cuts = [0]
            for k in row:
                tokens = pieces[k][2]
                ids[cuts[-1] : cuts[-1] + len(tokens)] = tokens
                positions[cuts[-1] : cuts[-1] + len(tokens)] = np.arange(len(tokens))
                cuts.append(cuts[-1] + len(tokens))
            out["pack_id"].append(number)
            out["n_tokens"].append(cuts[-1])
            out["ids"].append(ids.tobytes())
            out["cu_seqlens"].append(cuts)
            out["positions"].append(positions.tobytes())
            out["doc_ids"].append([pieces[k][0] for k in row])
            out["doc_starts"].append([pieces[k][1] for k in row])
            number += 1
            if len(out["ids"]) == 500:
                yield number, out
                out = {name: [] for name in out}
        yield number, out

    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def run(batches):
        encoder = tokenizers.byte_encoder(data)
        number = TaskContext.get().partitionId() << 33
        pieces, held = [], 0

        def done():
            nonlocal number
            for number, out in flush(pieces, number):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out)
                )

        for whole in batches:
            for batch in slices(whole):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    tokens = encoder.encode_to_numpy(text or "", disallowed_special=())
                    tokens = np.append(tokens, end).astype(kind)
                    for start in range(0, len(tokens), length):
                        pieces.append((doc_id, start, tokens[start : start + length]))
                    held += len(tokens)
                    if held >= buffer_tokens:
                        yield from done()
                        pieces, held = [], 0
        if pieces:
            yield from done()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, SCHEMA)
