"""Chunked encoding against the library, and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from namekin.llm import piece_scan, tokenizers


@pytest.fixture(scope="module")
def pieces():
    return piece_scan.Pieces(tokenizers.vocabulary(tokenizers.PIECES))


def scanned(pieces, text, chunk):
    """Encoding of one text by matrices, combination and traces, without Spark."""
    x = piece_scan.normal(text)
    cuts = [*range(0, len(x), chunk), len(x)]
    spans = list(zip(cuts, cuts[1:]))
    chain = [piece_scan.transfer(pieces, x, a, b) for a, b in spans]
    whole = {piece_scan.FRESH: {piece_scan.FRESH: 0.0}}
    suffix = [whole]
    for m in reversed(chain):
        suffix.insert(0, piece_scan.combine(m, suffix[0]))
    # associativity: folding from the left gives the same matrix
    left = whole
    for m in chain:
        left = piece_scan.combine(left, m)
    assert left == piece_scan.combine(whole, suffix[0])
    ids, entry = [], piece_scan.FRESH
    for k, (a, b) in enumerate(spans):
        leave = next(s for s in chain[k][entry] if s in suffix[k + 1])
        ids += piece_scan.trace(pieces, x, a, b, entry, leave)
        entry = leave
    return ids


TEXTS = [
    "Hello world, this is a longer sentence with someratherlongwordsinside.",
    "  two  spaces   and\ttabs\nand lines \n\n",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "internationalizationinternationalizationinternationalization",
    "ünïcödé ﬁ 漢字かな交じり文 😀😀 ▁ sign",
    "                                        ",
    "x", " ", "a b", "\n",
]


@pytest.mark.parametrize("chunk", [1, 2, 3, 5, 7, 16, 64])
def test_chunks_give_the_librarys_ids(pieces, chunk):
    for text in TEXTS:
        assert scanned(pieces, text, chunk) == pieces.library.encode(text), text


def test_random_texts(pieces):
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("aeinrst  thé\nx1.,ß漢") for _ in range(rng.randint(1, 80)))
        assert scanned(pieces, text, rng.randint(1, 12)) == pieces.library.encode(text), text


def test_pairs_are_what_the_merges_leave(pieces):
    for text in ("hello", "international", "aaaa", "▁the"):
        parts = pieces.merged(text)
        assert all(pieces.may_follow(a, b) for a, b in zip(parts, parts[1:]))


def test_spark_encoding_of_short_and_long_rows(spark, pieces):
    long = [" ".join(TEXTS) * 3, "unbroken" * 40, "a " * 150]
    rows = [(i, t, "x") for i, t in enumerate([*TEXTS, *long, None, "", "x"])] + [(None, "null id", None), (0, TEXTS[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string")
    encoded = piece_scan.encode(docs, chunk=64)
    assert encoded.columns == ["doc_id", "text", "row", "ids"]
    got = piece_scan.decode(encoded).collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r["ids"], "<i4").tolist() == pieces.library.encode(r["text"] or ""), r["text"]
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert piece_scan.decode(piece_scan.encode(docs)).count() == 0


def test_lengths_on_the_chunk_border(spark, pieces):
    docs = spark.createDataFrame([(n, "ab cdefg " * 20) for n in range(3)], "doc_id long, text string")
    docs = docs.withColumn("text", F.substring("text", 1, F.col("doc_id").cast("int") + 31))
    for r in piece_scan.encode(docs, chunk=32).collect():
        assert np.frombuffer(r["ids"], "<i4").tolist() == pieces.library.encode(r["text"])
