"""Word and name counts, count filters and frequency profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def words_of(df: DataFrame, name: str = "name_clean") -> DataFrame:
    """One row per word occurrence: column ``word`` next to the input columns. Blanks give none."""
    return df.withColumn("word", F.explode(F.split(F.col(name), " "))).filter(F.col("word") != "")


def build_vocabulary(
    df: DataFrame, name: str = "name_clean", weight: str | None = None
) -> DataFrame:
    """Word counts ``(word, counts)``.

    ``weight`` names a column of row multiplicities, so the input may be pre-aggregated names
    instead of records. Counts are combined before the shuffle, which spreads hot words.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    return words_of(df, name).groupBy("word").agg(amount.alias("counts"))


def sort_by_count(df: DataFrame, counts: str, key: str, ascending: bool = False) -> DataFrame:
    """Total order by count, ties by key."""
    count = F.col(counts).asc() if ascending else F.col(counts).desc()
    return df.orderBy(count, F.col(key).asc())


def frequent(df: DataFrame, minimum: int = 100, counts: str = "counts") -> DataFrame:
    return df.filter(F.col(counts) >= minimum)


def infrequent(df: DataFrame, minimum: int = 100, counts: str = "counts") -> DataFrame:
    return df.filter(F.col(counts) < minimum)


def find_words(df: DataFrame, words: Sequence[str], column: str = "word") -> DataFrame:
    """Point lookup of words in a vocabulary or correction table."""
    return df.filter(F.col(column).isin(list(words)))


def name_frequency(
    df: DataFrame,
    name: str = "name_clean",
    market: str | None = "market",
    weight: str | None = None,
    ranged: bool = False,
) -> DataFrame:
    """Counts per name and market: ``(name, market, freq)``; ``market=None`` counts globally.

    ``ranged`` is for rows that were counted before, so that few are left of each name: they are dealt out in the
    order of ``parents.sorted_names``, which then needs no shuffle of its own, and get its column ``blank``.
    """
    keys = [F.col(name).alias("name")] + ([F.col(market).alias("market")] if market else [])
    df = df.filter(F.col(name).isNotNull())
    if ranged:
        amount = F.col(weight) if weight else F.lit(1)
        df = df.select(*keys, (F.col(name) == "").alias("blank"), amount.alias("_amount"))
        keys = [*(["market"] if market else []), "blank", "name"]
        df, weight = df.repartitionByRange(*keys), "_amount"
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(*keys).agg(amount.alias("freq"))


def top_names(names: DataFrame, n: int, name: str = "name", freq: str = "freq") -> DataFrame:
    """The ``n`` most frequent names, ties by name."""
    return sort_by_count(names, freq, name).limit(n)


def table_shape(df: DataFrame) -> DataFrame:
    """Row and column count as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def profile_frequencies(
    df: DataFrame, column: str, weight: str | None = None, bands: Sequence[int] = (1000, 100, 10)
) -> DataFrame:
    """Names and occurrences per frequency band, as rows ``(band, names, total_freq)``.

    The ``>=`` bands are nested; the last row is everything below the smallest bound.
    """
    names = name_frequency(df, column, market=None, weight=weight)

    def band(label: str, inside: Column) -> Column:
        total = F.coalesce(F.sum(F.when(inside, F.col("freq"))), F.lit(0))
        return F.struct(
            F.lit(label).alias("band"),
            F.count_if(inside).alias("names"),
            total.cast("long").alias("total_freq"),
        )

    freq = F.col("freq")
    rows = [band(f">={b}", freq >= b) for b in bands] + [band(f"<{min(bands)}", freq < min(bands))]
    return names.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
