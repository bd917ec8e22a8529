"""Spelling correction: rare words are replaced by frequent words that look alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from namekin.functions.corrections import replacing
from namekin.functions.similarity import Similarity, reaches
from namekin.operators.blocking import candidate_pairs
from namekin.operators.skew import MAX_ROWS_PER_KEY, join_lookup
from namekin.operators.vocabulary import frequent, infrequent
from namekin.sources.scratch import written

#: Corrections, and characters in them, up to which every task holds their table (some 40 bytes a correction).
BROADCAST_CORRECTIONS, BROADCAST_CHARACTERS = 8_000_000, 1 << 28


def scored_pairs(
    pairs: DataFrame, left: str, right: str, similarity: Similarity = Similarity()
) -> DataFrame:
    """Add the similarity of two columns as ``score``."""
    return pairs.withColumn("score", similarity.column()(F.col(left), F.col(right)))


def build_spelling(
    vocabulary: DataFrame,
    min_count: int = 100,
    threshold: float = 0.95,
    prefix: int = 3,
    similarity: Similarity = Similarity(),
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Correction table ``(old_word, new_word, score)`` from word counts ``(word, counts)``.

    Each word below ``min_count`` goes to the most similar word at or above it that shares its
    prefix and reaches ``threshold``; ties go to the higher count, then to the smaller word.
    """
    known = written(vocabulary.filter(F.col("word") != "").select("word", "counts"), "vocabulary")
    common = frequent(known, min_count).select(F.col("word").alias("new_word"), "counts")
    rare = infrequent(known, min_count).select(F.col("word").alias("old_word"))
    pairs = candidate_pairs(
        common, rare, "new_word", "old_word", similarity, threshold, prefix, max_rows
    )
    scored = scored_pairs(pairs, "new_word", "old_word", similarity)
    best = Window.partitionBy("old_word").orderBy(
        F.round("score", 9).desc(), F.desc("counts"), F.asc("new_word")
    )
    return (
        scored.filter(reaches(F.col("score"), threshold))
        .withColumn("_rank", F.row_number().over(best))
        .filter(F.col("_rank") == 1)
        .select("old_word", "new_word", "score")
    )


@dataclass(frozen=True)
class Corrections:
    """One correction per misspelt word: their table and, if every task may hold it, the function that corrects a
    column of names by it."""

    table: DataFrame
    column: Callable[[Column], Column] | None


def corrections_of(spelling: DataFrame) -> Corrections:
    """The corrections of a table, to be used for several tables of names."""
    table = written(one_correction_each(spelling), "corrections")
    size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("old_word") + F.length("new_word")), F.lit(0))).first()
    held = size[0] <= BROADCAST_CORRECTIONS and size[1] <= BROADCAST_CHARACTERS
    return Corrections(table, replacing(table.sparkSession, table.toArrow()) if held else None)


def correct_names(
    names: DataFrame,
    spelling: DataFrame | Corrections,
    name: str = "name_clean",
    output: str = "name_corrected",
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Corrected form of each name that changes: distinct ``(name, output)``.

    ``names`` holds distinct names. With more than ``BROADCAST_CORRECTIONS`` corrections the words of the names are
    shuffled, each with a hash of its name. Names that share a hash get each other's corrections too, which
    changes nothing: a correction holds for its word in any name.
    """
    known = spelling if isinstance(spelling, Corrections) else corrections_of(spelling)
    if known.column is not None:
        corrected = names.select(name, F.lower(known.column(F.col(name))).alias(output))
    else:
        hashed = names.select(name, F.xxhash64(name).alias("_name"))
        words = hashed.select("_name", F.explode(F.array_distinct(F.split(F.col(name), " "))).alias("old_word"))
        fixes = join_lookup(words, known.table, ["old_word"], max_rows=max_rows)
        fixes = fixes.groupBy("_name").agg(
            F.map_from_entries(F.collect_set(F.struct("old_word", "new_word"))).alias("_fixes")
        )
        words = F.transform(
            F.split(F.col(name), " "), lambda w: F.coalesce(F.col("_fixes")[w], w)
        )
        corrected = hashed.join(fixes, "_name").select(name, F.lower(F.array_join(words, " ")).alias(output))
    return corrected.filter(F.col(output) != F.lower(name))


def one_correction_each(spelling: DataFrame) -> DataFrame:
    """``(old_word, new_word)``, one row per misspelt word: of several the best score (if there is a
    score column), then the smaller word. Rows without either word are left out."""
    rows = spelling.filter(F.col("old_word").isNotNull() & F.col("new_word").isNotNull())
    order = [(-F.round("score", 9)).alias("order")] if "score" in spelling.columns else []
    best = F.min(F.struct(*order, F.col("new_word"))).alias("best")
    return rows.groupBy("old_word").agg(best).select("old_word", "best.new_word")


def apply_spelling(
    df: DataFrame,
    spelling: DataFrame | Corrections,
    name: str = "name_clean",
    output: str | None = None,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Replace misspelt words in column ``name`` (into ``output`` if given); all rows are kept.

    Every name is lower-cased, corrected or not; words are separated by single spaces of the name, so
    runs of spaces stay as they are. Rows are corrected where they are, without a shuffle; with more than
    ``BROADCAST_CORRECTIONS`` corrections the changed ones of the distinct names are joined back.
    """
    known = spelling if isinstance(spelling, Corrections) else corrections_of(spelling)
    if known.column is not None:
        joined, value = df, F.lower(known.column(F.col(name)))
    else:
        changed = correct_names(df.select(name).distinct(), known, name, "_corrected", max_rows)
        joined = join_lookup(df, changed, [name], "left", max_rows=max_rows)
        value = F.coalesce("_corrected", F.lower(name))
    columns = [value.alias(c) if c == name and not output else F.col(c) for c in df.columns]
    return joined.select(*columns, *([value.alias(output)] if output else []))
