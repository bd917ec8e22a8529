"""SentencePiece encoding and decoding of texts of any length by a max-plus scan.

The model merges pieces by rank. A sequence of pieces is its encoding exactly if every neighbouring pair
would be left alone by the merges; so encoding is a best path with weight 0 for such pairs and minus
infinity for others, and has the algebra of Viterbi decoding.

A long text is cut into chunks at fixed places. The state at a cut is the piece that begins before it and
ends at or after it. Each chunk gives a matrix: for every possible state at its first cut the states at
its last one. The matrices are combined in (max, +), which is associative, each chunk then knows its
own states, and traces its own pieces back without the others. Pieces never reach over the start of
a word, so inside a chunk only the words cut by its borders need states; whole words in between are
segmented by the library. A text of one chunk has no unknown state and is encoded at once.

Defined cases: a null or blank text (no characters) has no pieces; ids are encoded row by row, so
repeated rows, equal ids and null ids change nothing; characters the model lacks become bytes; an
empty table gives an empty result; all columns are carried along, a column ``ids`` is replaced.
Decoding gives back the text, but for the sign U+2581, which the model writes for a space.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from namekin.llm import tokenizers
from namekin.llm.words import slices, whole
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a chunk.
CHUNK = 65_536
SPACE = "▁"
NEVER = float("-inf")
#: State where a new word begins: what came before does not matter.
FRESH = (0, 0, -1)


class Pieces:
    """The model: its pieces, the library's encoder, and which pieces may follow each other."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.vocab_size()
        special = (self.library.is_control, self.library.is_unknown, self.library.is_byte, self.library.is_unused)
        self.ids = {
            self.library.id_to_piece(i): i for i in range(size) if not any(f(i) for f in special)
        }
        self.score = {p: self.library.get_score(i) for p, i in self.ids.items()}
        self.names = {i: p for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        if any(SPACE in p.lstrip(SPACE) for p in self.ids) or self.library.normalize(" a  b") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b":
            raise ValueError("the model's pieces or its normalisation are not of the kind this scan serves")
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self._pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text, by merging the best pair until none is left."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def may_follow(self, left: str, right: str) -> bool:
        """Whether the merges leave this pair as it is; with no left piece, the right one alone."""
        key = (left, right)
        if key not in self._pairs:
            want = [left, right] if left else [right]
            self._pairs[key] = self.merged(left + right) == want
        return self._pairs[key]

    def piece_ids(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        return [found] if found is not None else [self.byte[b] for b in piece.encode()]


def normal(text: str) -> str:
    """The text as the model reads it."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def _word_start(x: str, at: int, stop: int) -> int | None:
    """First place from ``at`` on, before ``stop``, where a word begins."""
    for k in range(at, stop):
        if x[k] == SPACE and (k == 0 or x[k - 1] != SPACE):
            return k
    return None


class Lattice:
    """Paths of pieces through ``x``, from a state at ``low`` to the states at ``high``.

    States are ``(start, end, kind)`` with places in ``x``; kind -1 marks a fresh start.
    """

    def __init__(self, pieces: Pieces, x: str, low: int, high: int):
        self.pieces, self.x, self.low, self.high = pieces, x, low, high

    def run(self, entry: tuple) -> tuple[dict, dict]:
        """Weights of the states at the end, and the state before each state on the way."""
        at = self.low if entry == FRESH else entry[1]
        best, back = {entry: 0.0}, {}
        open_at = {at: [entry]}
        ends: dict[tuple, float] = {}
        if at >= self.high and entry != FRESH:
            return {entry: 0.0}, back
        for place in range(at, self.high):
            for state in open_at.pop(place, ()):
                left = "" if state == FRESH else self.x[state[0] : state[1]]
                for size in range(1, self.pieces.longest + 1):
                    right = self.x[place : place + size]
                    if len(right) < size:
                        break
                    if (size > 1 and right not in self.pieces.ids) or not self.pieces.may_follow(left, right):
                        continue
                    if not self.pieces.may_follow("", right):
                        continue
                    to, weight = (place, place + size, 0), best[state]
                    if best.get(to, NEVER) < weight:
                        fresh = to not in best
                        best[to], back[to] = weight, state
                        if to[1] >= self.high:
                            ends[to] = weight
                        elif fresh:
                            open_at.setdefault(to[1], []).append(to)
        return ends, back


def entry_states(pieces: Pieces, x: str, at: int) -> list[tuple]:
    """All states that may hold at a cut: a fresh word, or a piece over the cut or up to it."""
    if at == 0 or at >= len(x) or (x[at] == SPACE and x[at - 1] != SPACE):
        return [FRESH]
    out = []
    for start in range(max(0, at - pieces.longest), at):
        for end in range(at, min(len(x), start + pieces.longest) + 1):
            piece = x[start:end]
            if len(piece) == 1 or piece in pieces.ids:
                out.append((start, end, 0))
    return out


def _at_end(states: dict, at: int, x: str) -> dict:
    """States at a cut as the next chunk names them: at the start of a word nothing else matters."""
    if at >= len(x) or (x[at] == SPACE and x[at - 1] != SPACE):
        exact = [w for s, w in states.items() if s[1] == at]
        return {FRESH: max(exact)} if exact else {}
    return states


def _borders(x: str, low: int, high: int) -> tuple[int | None, int | None]:
    """First and last start of a word in a stretch."""
    first = _word_start(x, low, high)
    if first is None:
        return None, None
    last = high - 1
    while not (x[last] == SPACE and (last == 0 or x[last - 1] != SPACE)):
        last -= 1
    return first, last


def transfer(pieces: Pieces, x: str, low: int, high: int) -> dict[tuple, dict[tuple, float]]:
    """Matrix of a chunk ``x[low:high]``; ``x`` holds some text on either side as well."""
    first, last = _borders(x, low, high)
    if first is None:
        return {
            e: _at_end(Lattice(pieces, x, low, high).run(e)[0], high, x) for e in entry_states(pieces, x, low)
        }
    out = {}
    tail = _at_end(Lattice(pieces, x, last, high).run(FRESH)[0], high, x)
    for e in entry_states(pieces, x, low):
        if first == low:
            reach = {FRESH: 0.0}
        else:
            reach = _at_end(Lattice(pieces, x, low, first).run(e)[0], first, x)
        if reach:
            out[e] = {s: w + reach[FRESH] for s, w in tail.items()}
    return out


def combine(left: dict, right: dict) -> dict:
    """Product of two matrices in (max, +)."""
    out = {}
    for e, row in left.items():
        reach: dict[tuple, float] = {}
        for middle, w in row.items():
            for s, v in right.get(middle, {}).items():
                if w + v > reach.get(s, NEVER):
                    reach[s] = w + v
        if reach:
            out[e] = reach
    return out


def trace(pieces: Pieces, x: str, low: int, high: int, entry: tuple, leave: tuple) -> list[int]:
    """Ids of the pieces that begin in the chunk, between two known states."""
    def path(lattice, start, stop):
        ends, back = lattice.run(start)
        if stop == FRESH:
            exact = {s: w for s, w in ends.items() if s[1] == lattice.high}
            stop = max(exact, key=exact.get)
        names = []
        while stop != start:
            names.append(x[stop[0] : stop[1]])
            stop = back[stop]
        return [i for name in reversed(names) for i in pieces.piece_ids(name)]

    first, last = _borders(x, low, high)
    if first is None:
        return path(Lattice(pieces, x, low, high), entry, leave)
    head = [] if first == low else path(Lattice(pieces, x, low, first), entry, FRESH)
    middle = x[first:last]  # whole words; the library puts the first sign back itself
    ids = pieces.library.encode(middle[1:].replace(SPACE, " ")) if middle else []
    if middle and len(middle) == 1:
        ids = pieces.piece_ids(SPACE)
    return head + ids + path(Lattice(pieces, x, last, high), FRESH, leave)


# The Spark side.

_STATE = "struct<first:long,end:long,kind:long>"
_PARTS = "row long, chunk long, before string, body string, after string"


def _shifted(state, by: int) -> tuple:
    return FRESH if state[2] < 0 else (state[0] + by, state[1] + by, 0)


def _cut(chunk: int, reach: int):
    """Chunks of long texts, each with the text around it that its states may need."""
    def run(batches):
        for whole_batch in batches:
            for batch in slices(whole_batch):
                for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                    x = normal(text)
                    rows = [
                        (row, k, x[max(0, at - reach) : at], x[at : at + chunk], x[at + chunk : at + chunk + reach])
                        for k, at in enumerate(range(0, len(x), chunk))
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()))],
                        names=["row", "chunk", "before", "body", "after"],
                    )

    return run


def _long_ids(giants: DataFrame, model: bytes, chunk: int) -> DataFrame:
    """``(row, ids)`` of long texts; chunks are spread over all tasks whatever text they come from."""
    reach = 2 * Pieces(model).longest + 1
    parts = written(
        giants.select("row", "text").mapInArrow(_cut(chunk, reach), _PARTS).repartition("row", "chunk"), "chunks"
    )
    pair = "row long, chunk long, entry " + _STATE + ", leave " + _STATE

    def matrices(batches):
        pieces = Pieces(model)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                x, low = r["before"] + r["body"] + r["after"], len(r["before"])
                at = r["chunk"] * chunk - low
                for e, reached in transfer(pieces, x, low, low + len(r["body"])).items():
                    rows += [(r["row"], r["chunk"], _shifted(e, at), _shifted(s, at)) for s in reached]
            yield _state_batch(rows)

    def states(key, table):
        """Entry and exit state of every chunk of one text, from the combined matrices."""
        chain: dict[int, dict] = {}
        for r in table.to_pylist():
            e, s = (tuple(r[c].values()) for c in ("entry", "leave"))
            chain.setdefault(r["chunk"], {}).setdefault(e, {})[s] = 0.0
        n = len(chain)
        # Scan from the end: what each chunk and all after it lead to, so dead ends are known.
        suffix = {n: {FRESH: {FRESH: 0.0}}}
        for k in range(n - 1, -1, -1):
            suffix[k] = combine(chain[k], suffix[k + 1])
        rows, entry = [], FRESH
        for k in range(n):
            leave = max(
                (s for s in chain[k][entry] if s in suffix[k + 1]),
                key=lambda s: chain[k][entry][s] + max(suffix[k + 1][s].values()),
            )
            rows.append((key[0].as_py(), k, entry, leave))
            entry = leave
        return pa.Table.from_batches([_state_batch(rows)])

    found = parts.mapInArrow(matrices, pair).groupBy("row").applyInArrow(states, pair)
    known = parts.join(found, ["row", "chunk"])

    def traced(batches):
        pieces = Pieces(model)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                x, low = r["before"] + r["body"] + r["after"], len(r["before"])
                at = r["chunk"] * chunk - low
                entry, leave = (_shifted(tuple(r[c].values()), -at) for c in ("entry", "leave"))
                ids = trace(pieces, x, low, low + len(r["body"]), entry, leave)
                out.append(np.array(ids, "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("chunk"), pa.array(out, pa.binary())],
                names=["row", "chunk", "ids"],
            )

    ids = known.mapInArrow(traced, "row long, chunk long, ids binary")
    # one text's ids together, as its result needs them
    joined = ids.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"))
    empty = F.lit(b"").cast("binary")
    return joined.select("row", F.aggregate("parts", empty, lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def _state_batch(rows: list[tuple]) -> pa.RecordBatch:
    kind = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("kind", pa.int64())])
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    states = [
        pa.array([dict(zip(("first", "end", "kind"), s)) for s in c], kind) for c in columns[2:]
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), *states],
        names=["row", "chunk", "entry", "leave"],
    )


def encode(
    docs: DataFrame, chunk: int = CHUNK, folder: str = tokenizers.FOLDER, model: str = tokenizers.PIECES
) -> DataFrame:
    """``docs`` with ``ids``: the piece ids of ``text`` as little-endian 4-byte integers."""
    data = tokenizers.vocabulary(model, folder)
    columns = [c for c in docs.columns if c.lower() != "ids"]
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("whole")
    rows = docs.select(row, whole("text").alias("text"))
    kind = docs.select(row).schema["whole"].dataType.simpleString()

    def run(batches):
        pieces = Pieces(data).library
        for whole_batch in batches:
            for batch in slices(whole_batch):
                ids = pieces.encode(batch.column("text").to_pylist(), num_threads=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("whole"), pa.array([np.array(i, "<i4").tobytes() for i in ids], pa.binary())],
                    names=["whole", "ids"],
                )

    is_long = F.length("text") >= chunk
    short = rows.filter(~is_long).mapInArrow(run, f"whole {kind}, ids binary")
    giants = written(rows.filter(is_long).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    if not giants.isEmpty():
        short = short.unionByName(
            giants.join(_long_ids(giants, data, chunk), "row").select("whole", "ids")
        )
    return short.select("whole.*", "ids")


def decode(
    encoded: DataFrame, folder: str = tokenizers.FOLDER, model: str = tokenizers.PIECES
) -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ``ids`` (null for null)."""
    data = tokenizers.vocabulary(model, folder)
    columns = [c for c in encoded.columns if c.lower() not in ("ids", "decoded")]
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("whole")
    kind = encoded.select(row).schema["whole"].dataType.simpleString()

    def run(batches):
        pieces = Pieces(data).library
        for batch in batches:
            for part in slices(batch, "ids"):
                ids = [None if i is None else np.frombuffer(i, "<i4").tolist() for i in part.column("ids").to_pylist()]
                texts = [None if i is None else pieces.decode(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column("whole"), part.column("ids"), pa.array(texts, pa.string())],
                    names=["whole", "ids", "decoded"],
                )

    rows = encoded.select(row, "ids").mapInArrow(run, f"whole {kind}, ids binary, decoded string")
    return rows.select("whole.*", "ids", "decoded")
