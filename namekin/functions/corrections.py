"""Words of names replaced from a table of corrections, a batch of names at a time.

The table is held sorted by a 64-bit hash of the word, as arrays: some 40 bytes a word instead of several
hundred in a dictionary. Words are compared in full, the hash only tells where to look.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession, functions as F

# Ship the code with the UDF, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def packed(old: pa.Array, new: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """``(hashes, old, new)`` by rising hash, of words that are distinct in ``old``."""
    hashes = _hashes(old)
    order = np.argsort(hashes, kind="stable")
    return hashes[order], old.take(pa.array(order)), new.take(pa.array(order))


def replaced(names: pa.Array, table: tuple[np.ndarray, pa.Array, pa.Array]) -> pa.Array:
    """The names with every word, as cut at single spaces, that stands in the table replaced; null stays null."""
    split = pc.split_pattern(names.fill_null(""), " ")
    coded = pc.list_flatten(split).dictionary_encode()
    words = _corrected(coded.dictionary, table).take(coded.indices)
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    joined = pc.binary_join(pa.ListArray.from_arrays(offsets, words), " ")
    return pc.if_else(names.is_valid(), joined, pa.scalar(None, joined.type))


def _corrected(words: pa.Array, table: tuple[np.ndarray, pa.Array, pa.Array]) -> pa.Array:
    hashes, old, new = table
    wanted = _hashes(words)
    at, target = np.searchsorted(hashes, wanted), np.full(len(words), -1)
    while True:  # more than once only if words of the table share a hash
        some = np.flatnonzero(at < len(hashes))
        some = some[hashes[at[some]] == wanted[some]]
        if not some.size:
            break
        same = pc.equal(old.take(pa.array(at[some])), words.take(pa.array(some))).to_numpy(zero_copy_only=False)
        target[some[same]] = at[some[same]]
        at = at + 1
    found = target >= 0
    return pc.replace_with_mask(words, pa.array(found), new.take(pa.array(target[found])))


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def replacing(spark: SparkSession, table: pa.Table):
    """Function of a string column that replaces its words by ``table (old_word, new_word)``, which every
    task holds.

    Non-deterministic to Catalyst, so names that are used twice are not worked out twice.
    """
    old, new = (table.column(c).cast(pa.string()).combine_chunks() for c in ("old_word", "new_word"))
    shared = spark.sparkContext.broadcast(packed(old, new))

    @F.arrow_udf("string")
    def replace_words(names: pa.Array) -> pa.Array:
        return replaced(names.cast(pa.string()), shared.value)

    return replace_words.asNondeterministic()
