"""Words of texts: as column expressions, and as hashed arrays for code that runs on Arrow batches.

Two word rules are used: runs without white space (bytes 20 and 09-0D), kept as written, and runs of
digits, a-z and everything beyond ASCII after A-Z has been lower-cased. A null text has no words.
"""

from __future__ import annotations

import string
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE_RUN = "[\\x20\\x09-\\x0D]+"
OUTSIDE_RUN = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BATCH_BYTES = 1 << 21

_RANDOM = np.random.default_rng(20240611)
_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[65:91] = _CODES[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_IS_OTHER = np.ones(256, bool)
_IS_OTHER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def whole(text: Column | str) -> Column:
    """The text, blank if null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is; pure ASCII takes the built-in way."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def spaced_words(text: Column) -> Column:
    """Array of the runs without white space."""
    return F.array_remove(F.split(whole(text), SPACE_RUN), "")


def plain_words(text: Column) -> Column:
    """Array of the lower-cased runs of digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(lower_ascii(whole(text)), OUTSIDE_RUN), "")


def small_enough(df: DataFrame, rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is.

    ``df`` should be a written table: its rows are counted.
    """
    return F.broadcast(df) if df.count() <= rows else df


# Hashed words. Texts are handled as one byte array, so cost per word stays at a few nanoseconds.

def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base and of its inverse, modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        p = np.full(n + 1, np.uint64(b), np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for every span."""
    power, inverse = _powers(base, len(values))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts together, and the offset where each begins, with the end."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word without white space, and the words before each text."""
    return _bounds(data, offsets, _IS_SPACE)


def letter_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for runs of letters; everything beyond ASCII counts as a letter."""
    return _bounds(data, offsets, _IS_OTHER)


def _bounds(
    data: np.ndarray, offsets: np.ndarray, between: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    space = between[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, space[1:]
    borders = offsets[1:-1]
    before[borders[borders < len(data)]] = True
    after[borders[borders > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """64-bit hash of every word, computed over stretches of bounded length."""
    codes = _LOWER_CODES if lower else _CODES
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + BATCH_BYTES, "right")))
        values = codes[data[base : ends[last - 1]]]
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mixed(_spans(values, s, e, _BYTE_BASE) + (e - s).astype(np.uint64))
        first = last
    return out


def hash_windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``words[i : i + size]`` for every i; windows are not held within texts here."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = BATCH_BYTES // 8
    for first in range(0, n, step):
        last = min(n, first + step)
        starts = np.arange(last - first)
        out[first:last] = mixed(
            _spans(words[first : last + size - 1], starts, starts + size, _WORD_BASE)
        )
    return out


def within_texts(counts_before: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` words begin and end in one text."""
    n = max(0, int(counts_before[-1]) - size + 1)
    ends = np.repeat(counts_before[1:], np.diff(counts_before))[:n]
    return ends >= np.arange(n) + size


def slices(batch: pa.RecordBatch, text: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``BATCH_BYTES`` of text each, at least one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    first = 0
    while first < batch.num_rows:
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + BATCH_BYTES, "right")))
        yield batch.slice(first, last - first)
        first = last
