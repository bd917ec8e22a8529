"""Benchmark decontamination with a positional inverted index of the training texts.

1. The terms of all test windows are counted over the training texts.
2. Each window is looked up under its rarest term. Postings ``(term, document, position)`` of these
   terms, each with the words around it, are written as the index.
3. A posting minus the term's offset in the window is where the window would begin; the neighbouring
   words decide. Phrases must match word for word; for proximity matches every word of the window
   must stand within a somewhat wider span.

Only the test side is ever broadcast, and only below a stated number of rows; beyond it the same joins
shuffle. A passage that many documents share gives one row per place and is grouped by document.

Defined cases: null or blank texts have no words, are never hit and hit nothing; an item with fewer
words than a window is one window; equal items are all reported; rows with equal id and text get equal
results, and equal ids (or null ids) with different texts stay apart; empty tables give no hits; the
columns ``doc_id, text`` and ``item_id, text`` are read, no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from namekin.llm.words import plain_words, small_enough, whole
from namekin.sources.scratch import written

WINDOW = 13
#: Largest test side, in rows of terms or windows, that is broadcast.
BROADCAST_ROWS = 200_000
_KEYS = ("_id", "_text")


def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with the key that results are joined by, and their words."""
    return docs.select(
        F.col("doc_id").alias("_id"), F.xxhash64(whole("text")).alias("_text"),
        plain_words(F.col("text")).alias("_words"),
    )


def test_windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``(item_id, window)``: every run of ``size`` words, or all words of a shorter item."""
    words = items.select("item_id", plain_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return words.select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, size))).alias("window")
    ).distinct()


def rarest_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``(item_id, window, term, offset)`` with the term of each window that the documents hold least.

    Windows with a term that no document holds are left out: they occur nowhere.
    """
    terms = windows.select(F.explode("window").alias("term")).distinct()
    terms = small_enough(written(terms, "terms"), BROADCAST_ROWS)
    counts = (
        _keyed(docs).select(F.explode("_words").alias("term"))
        .join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = small_enough(written(counts, "term-counts"), BROADCAST_ROWS)
    placed = windows.select("item_id", "window", F.posexplode("window").alias("offset", "term"))
    known = placed.join(counts, "term", "left")
    best = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")).alias("b")
    return (
        known.groupBy("item_id", "window").agg(best).filter("b.n > 0")
        .select("item_id", "window", "b.term", "b.offset")
    )


def postings(docs: DataFrame, terms: DataFrame, around: int) -> DataFrame:
    """Index rows ``(_id, _text, term, at, first, near)`` of the given terms: the position, and the words
    from position ``first`` on, up to ``around`` on either side."""
    placed = _keyed(docs).select(*_KEYS, "_words", F.posexplode("_words").alias("at", "term"))
    first = F.greatest(F.col("at") - around, F.lit(0))
    return placed.join(terms, "term").select(
        *_KEYS, "term", "at", first.alias("first"),
        F.slice("_words", first + 1, F.col("at") - first + around + 1).alias("near"),
    )


def _phrase(start: Column) -> Column:
    """The window stands word for word at ``start``, a position in ``near``."""
    return (start >= 0) & (F.slice("near", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))


def _close(start: Column, slack: int) -> Column:
    """Every word of the window stands within its length and ``slack`` words about its place."""
    low = F.greatest(start - slack, F.lit(0))
    span = F.slice("near", low + 1, start - low + F.size("window") + slack)
    return F.size(F.array_except("window", span)) == 0


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, slack: int | None = None) -> DataFrame:
    """``(_id, _text, item_id, start, length)`` of every place where a test window occurs.

    With ``slack`` the words may stand in any order, up to ``slack`` words further apart on either
    side; ``start`` is then where the phrase would begin.
    """
    windows = written(rarest_terms(docs, written(test_windows(items, size), "windows")), "rarest")
    terms = small_enough(written(windows.select("term").distinct(), "index-terms"), BROADCAST_ROWS)
    index = written(postings(docs, terms, size - 1 + (slack or 0)), "postings")
    found = index.join(small_enough(windows, BROADCAST_ROWS), "term")
    start = F.col("at") - F.col("offset") - F.col("first")
    found = found.filter(_phrase(start) if slack is None else _close(start, slack))
    return found.select(
        *_KEYS, "item_id", (start + F.col("first")).alias("start"), F.size("window").alias("length")
    )


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_hit, item_ids, contaminated)``.

    ``n_hit`` words lie in a place where a test window occurs; ``item_ids`` are the items of these
    windows as sorted strings.
    """
    hits = matches(docs, items, size).groupBy(*_KEYS).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def covered(seen, s):
        end = s["start"] + s["length"]
        fresh = F.greatest(end - F.greatest(s["start"], seen["end"]), F.lit(0))
        return F.struct(F.greatest(end, seen["end"]).alias("end"), (seen["n"] + fresh).alias("n"))

    hits = hits.select(
        *[F.col(k).alias(f"h{k}") for k in _KEYS],
        F.aggregate("spans", zero, covered)["n"].alias("n_hit"), "item_ids",
    )
    rows = _keyed(docs).select(*_KEYS, F.size("_words").cast("long").alias("n_words"))
    joined = rows.join(
        hits, F.col("_id").eqNullSafe(F.col("h_id")) & (F.col("_text") == F.col("h_text")), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        F.col("_id").alias("doc_id"), "_text", "n_words", n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    marks = contamination(docs, items, size).filter("contaminated").select("doc_id", "_text").distinct()
    marks = small_enough(written(marks, "contaminated"), BROADCAST_ROWS)
    # whole rows travel in one column, so no name of theirs meets a name used here
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id").alias("id"), F.xxhash64(whole("text")).alias("hash"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("_text"))
    return rows.join(marks, same, "left_anti").select("row.*")
