"""Name counts over a moving window of months, from a state of daily counts.

Counts of days add up, so a window is a sum of days. The state is a table of counts per day and key, one
folder per month. A run counts the records of new days only; the counts of the next window are those of the last
one, plus the days that enter, less the days that leave. The result is what a count of all records of the
window would give. Only months with such days are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from namekin.sources.scratch import written

DAY, MONTH, COUNT = "day", "month", "freq"


def daily_counts(records: DataFrame, keys: Sequence[str], date: str = "as_of") -> DataFrame:
    """``(keys, freq, day)``: records per key and day; records without a date are in no window."""
    rows = records.filter(F.col(date).isNotNull()).withColumn(DAY, F.col(date).cast("date"))
    return rows.groupBy(*keys, DAY).agg(F.count(F.lit(1)).alias(COUNT)).select(*keys, COUNT, DAY)


def _months(counts: DataFrame) -> DataFrame:
    return counts.withColumn(MONTH, F.date_format(DAY, "yyyy-MM"))


def store_days(counts: DataFrame, path: str) -> None:
    """Put daily counts into the state at ``path``. The days in ``counts`` replace what the state has of them,
    so storing a day again does no harm; other days stay. Copies of a key on a day are added up.

    The months of these days are written anew, all others stay as they are.
    """
    spark = counts.sparkSession
    keys = [c for c in counts.columns if c not in (DAY, COUNT)]
    new = written(counts.groupBy(*keys, DAY).agg(F.sum(COUNT).alias(COUNT)).select(*keys, COUNT, DAY), "new-days")
    rows = _months(new)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        days = _months(new.select(DAY).distinct())  # at most one row per day
        old = spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("string"))
        old = old.join(F.broadcast(days.select(MONTH).distinct()), MONTH, "left_semi")
        old = old.join(F.broadcast(days.select(DAY)), DAY, "left_anti")
        rows = rows.unionByName(written(old.select(*rows.columns), "old-days"))
    # a month goes to one task, or to several if it is large
    writer = rows.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def stored_days(spark: SparkSession, path: str, first: str | None = None, end: str | None = None) -> DataFrame:
    """The state's counts of days from ``first`` up to, but not with, ``end``; other folders are not read."""
    return _spans(spark, path, [(first or "0001-01-01", end or "9999-12-31")])


def window_counts(days: DataFrame) -> DataFrame:
    """``(keys, freq)``: the counts of some days added up."""
    keys = [c for c in days.columns if c not in (DAY, COUNT)]
    return days.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT))


def moved(counts: DataFrame, entering: DataFrame, leaving: DataFrame) -> DataFrame:
    """Counts of the next window: ``counts`` of the last one with the days that enter and without those that
    leave. Keys that are left with no record go; a null key is a key like any other."""
    keys = [c for c in counts.columns if c != COUNT]
    change = window_counts(entering).unionByName(window_counts(leaving).withColumn(COUNT, -F.col(COUNT)))
    both = counts.select(*keys, COUNT).unionByName(change.select(*keys, COUNT))
    return both.groupBy(*keys).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)


def move(spark: SparkSession, counts: DataFrame, state: str, old: tuple[str, str], new: tuple[str, str]) -> DataFrame:
    """``counts`` of the window ``old`` (first day, day after the last) brought to the window ``new``.

    Windows may move forward or back and overlap or not; only the days in one of the two are read.
    """
    (a, b), (c, d) = (tuple(map(str, w)) for w in (old, new))
    entering, leaving = (
        [span for span in spans if span[0] < span[1]]
        for spans in (
            [(c, min(d, max(a, c))), (max(c, min(b, d)), d)] if a < b else [(c, d)],
            [(a, min(b, max(c, a))), (max(a, min(d, b)), b)] if c < d else [(a, b)],
        )
    )
    return moved(counts, _spans(spark, state, entering), _spans(spark, state, leaving))


def _spans(spark: SparkSession, state: str, spans: list[tuple[str, str]]) -> DataFrame:
    inside = F.lit(False)
    for first, end in spans:
        month = F.col(MONTH).cast("string").between(first[:7], end[:7])
        inside = inside | (month & (F.col(DAY) >= F.lit(first).cast("date")) & (F.col(DAY) < F.lit(end).cast("date")))
    return spark.read.parquet(state).filter(inside).drop(MONTH)
