"""Joins that stay balanced when one key holds a large share of all rows.

Both forms find the heavy keys, those with more than a stated number of rows, and split these alone: the
large side takes a part by a hash of the row, the other side is repeated once per part, and an ordinary join
on key and part does the rest. Light keys are never repeated, however many there are.

Heavy keys come from known counts, or from a sketch of the most frequent keys: each task sums up its rows in
at most ``TRACKED`` counters, and the sketches are merged in two steps. A key with more than about
``4 / TRACKED`` of all rows is never missed, and what is missed is a small share of one task's work at any
size. The table of heavy keys is broadcast; it has at most ``HEAVIEST`` rows of two numbers, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MAX_ROWS_PER_KEY = 1_000_000
HEAVIEST, TRACKED = 10_000, 1 << 14
#: Sketches that are merged at the same time before the last merge.
MERGED_APART = 64


def _heavy_keys(rows: DataFrame, keys: Sequence[str], max_rows: int, weight: str | None = None) -> DataFrame:
    """``(_hash, _parts)``: hashes of the keys with more than ``max_rows`` rows, the ``HEAVIEST`` of them.

    ``rows`` has a row per row of the table, or, with ``weight``, keys with their number of rows in that column.
    """
    hashed = F.xxhash64(*keys).alias("_hash")
    if weight is None:
        some = F.pmod(F.spark_partition_id(), F.lit(MERGED_APART)).alias("_some")
        sketched = rows.select(hashed, some).groupBy("_some").agg(F.expr(f"approx_top_k_accumulate(_hash, {TRACKED})").alias("_sketch"))
        merged = sketched.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"))
        found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(_sketch, {HEAVIEST})")).alias("_key"))
        counted = found.select(F.col("_key.item").alias("_hash"), F.col("_key.count").alias("_rows")).filter(F.col("_rows") > max_rows)
    else:
        counted = rows.groupBy(hashed).agg(F.sum(weight).alias("_rows")).filter(F.col("_rows") > max_rows)
        counted = counted.orderBy(F.desc("_rows")).limit(HEAVIEST)
    return counted.select("_hash", F.ceil(F.col("_rows") / max_rows).cast("int").alias("_parts"))


def join_lookup(
    big: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    weight: str = "n",
    max_rows: int = MAX_ROWS_PER_KEY,
    null_safe: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """``big`` joined (inner or left) to a table with few rows per key, in one shuffle of ``big``.

    ``counts`` may hold the keys with their number of rows in column ``weight``; otherwise the keys of
    ``big`` are sketched first. Copies of a row share key and part, so ``distinct`` removes repeated
    rows of the result after the join, in the same partitioning.
    """
    keys = list(keys)
    known = counts if counts is not None else big.select(*keys)
    heavy = F.broadcast(_heavy_keys(known, keys, max_rows, weight if counts is not None else None))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    left = (
        big.withColumn("_hash", F.xxhash64(*keys)).join(heavy, "_hash", "left")
        .withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), parts).cast("int"))
        .drop("_hash", "_parts")
    )
    right = (
        lookup.withColumn("_hash", F.xxhash64(*keys)).join(heavy, "_hash", "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_hash", "_parts")
    )
    if null_safe:
        # Hash and part alone decide the partitioning, so that distinct can use it; the keys are compared
        # on top, in a form that Catalyst does not turn into join keys.
        left = left.withColumn("_hash", F.xxhash64(*keys))
        right = right.withColumn("_hash", F.xxhash64(*keys))
        right = right.withColumnsRenamed({k: f"_other_{k}" for k in [*keys, "_part", "_hash"]})
        same = (F.col("_part") == F.col("_other__part")) & (F.col("_hash") == F.col("_other__hash"))
        for k in keys:
            other = F.col(f"_other_{k}")
            same = same & F.coalesce(F.col(k) == other, F.col(k).isNull() & other.isNull())
        joined = left.join(right, same, how).drop(*[f"_other_{k}" for k in [*keys, "_part", "_hash"]])
    else:
        joined = left.join(right, [*keys, "_part"], how)
    return (joined.dropDuplicates() if distinct else joined).drop("_part", "_hash")


def split_blocks(
    big: DataFrame,
    small: DataFrame,
    block: str,
    spread: Column,
    max_rows: int = MAX_ROWS_PER_KEY,
    other_spread: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add ``_part`` and ``_other_part`` to both sides of a many-to-many join on ``block`` (a long).

    A block with more than ``max_rows`` rows on a side is cut there into parts by a hash of ``spread`` (of
    ``other_spread`` on the side ``small``, which is left whole without it), and the rows of the other side
    are repeated once per part: a grid in which every pair meets once. The spreads must differ between the
    rows of a block. Join on the block and both parts.
    """
    own = _heavy_keys(big.select(block), [block], max_rows).withColumnRenamed("_parts", "_own")
    if other_spread is None:
        grid = own.withColumn("_others", F.lit(1))
    else:
        others = _heavy_keys(small.select(block), [block], max_rows).withColumnRenamed("_parts", "_others")
        grid = own.join(others, "_hash", "full").na.fill(1, ["_own", "_others"])
    grid = F.broadcast(grid)  # at most twice HEAVIEST rows
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))
    part_of = lambda x, n: F.pmod(F.xxhash64(x), F.coalesce(F.col(n), F.lit(1))).cast("int")
    split = (
        big.withColumn("_hash", F.xxhash64(block)).join(grid, "_hash", "left")
        .withColumn("_part", part_of(spread, "_own"))
        .withColumn("_other_part", all_of("_others")).drop("_own", "_others", "_hash")
    )
    one = F.lit(0) if other_spread is None else part_of(other_spread, "_others")
    repeated = (
        small.withColumn("_hash", F.xxhash64(block)).join(grid, "_hash", "left")
        .withColumn("_other_part", one)
        .withColumn("_part", all_of("_own")).drop("_own", "_others", "_hash")
    )
    return split, repeated
