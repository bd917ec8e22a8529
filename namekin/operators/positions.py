"""Row positions after a sort, and frames of neighbouring rows, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from namekin.sources.scratch import written

#: Rows of the table of shifts (one per sorted partition and group) up to which it is broadcast.
BROADCAST_SHIFTS = 100_000
_ROW_BITS = 33  # layout of monotonically_increasing_id: partition above, row below


def with_positions(df: DataFrame, groups: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``pos`` (0-based, in ``order`` within ``groups``) and ``n`` (rows of the group).

    ``groups`` and ``order`` together must be unique. The rows are range-sorted and written once;
    then every sorted partition is numbered locally and shifted by the rows of its group in
    earlier partitions. A group of any size is thus spread over many tasks, and the window that
    adds up the shifts only sees one row per partition and group.
    """
    ranged = df.orderBy(*groups, *order).withColumn("_id", F.monotonically_increasing_id())
    ranged = written(ranged, "sorted", "zstd").withColumns({
        "_run": F.shiftright("_id", _ROW_BITS),
        "_row": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1),
    }).drop("_id")
    group = Window.partitionBy(*groups)
    before = group.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*groups, "_run")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .select(
            *groups, "_run",
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
            F.sum("_rows").over(group).alias("n"),
        )
    )
    shifts = written(shifts.withColumnsRenamed({c: f"_of_{c}" for c in [*groups, "_run"]}), "shifts")
    if shifts.count() <= BROADCAST_SHIFTS:
        shifts = F.broadcast(shifts)
    same = F.col("_run") == F.col("_of__run")
    for c in groups:  # a null is a group like any other
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return (
        ranged.join(shifts, same)
        .withColumn("pos", F.col("_row") + F.col("_shift"))
        .drop("_run", "_row", "_shift", *[f"_of_{c}" for c in [*groups, "_run"]])
    )


def neighbour_frames(
    positioned: DataFrame,
    groups: Sequence[str],
    payload: Sequence[str],
    rng: int,
    bucket_size: int = 1024,
) -> DataFrame:
    """Add ``neighbours``: the up to ``rng`` rows before and after each row, in position order, as
    structs of ``pos`` and ``payload``.

    Positions are cut into buckets; rows near a border are copied into the next bucket, so each
    bucket is complete by itself and no task holds more than ``bucket_size + 2 * rng`` rows of it.
    """
    spread = in_buckets(positioned, rng, bucket_size)
    framed = spread.withColumn("neighbours", F.collect_list(F.struct("pos", *payload)).over(frame(groups, rng)))
    return (
        framed.filter(at_home(bucket_size)).drop("_bucket")
        .withColumn("neighbours", F.filter("neighbours", lambda x: x["pos"] != F.col("pos")))
    )


def in_buckets(positioned: DataFrame, rng: int, bucket_size: int) -> DataFrame:
    """The rows with their ``_bucket`` of positions, those near a border also with the bucket beyond it."""
    bucket = lambda pos: F.floor(pos / bucket_size)
    pos = F.col("pos")
    return positioned.withColumn(
        "_bucket",
        F.explode(F.sequence(
            bucket(F.greatest(pos - rng, F.lit(0))),
            bucket(F.least(pos + rng, F.col("n") - 1)),
        )),
    )


def frame(groups: Sequence[str], rng: int) -> WindowSpec:
    """The rows up to ``rng`` positions away, within a bucket."""
    return Window.partitionBy(*groups, "_bucket").orderBy("pos").rowsBetween(-rng, rng)


def at_home(bucket_size: int) -> Column:
    """Whether a row stands in its own bucket."""
    return F.col("_bucket") == F.floor(F.col("pos") / bucket_size)
