"""Joining parents back to the records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from namekin.operators.skew import MAX_ROWS_PER_KEY, join_lookup


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each full row once. Copies are combined before the shuffle, so a hot row costs one per task."""
    return df.dropDuplicates()


def attach_parents(
    records: DataFrame,
    parents: DataFrame,
    key: str = "name_market",
    name: str = "name_clean",
    market: str = "market",
    counts: DataFrame | None = None,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Distinct ``(record_id, raw_name, name_clean, parent_name, market, score)``.

    ``parents`` holds ``(name, market, parent_name)``. With ``key="name"`` the market is not
    compared: a record gets the parents its name has in any market; the market shown is the
    record's own. Null markets are equal to each other. ``counts`` may give the records per join key,
    in column ``n``; otherwise they are counted. Records are shuffled once: the join removes
    their copies too.
    """
    if key not in ("name", "name_market"):
        raise ValueError(f"unknown join key {key!r}")
    keys = [name] if key == "name" else [name, market]
    table = parents.withColumnsRenamed({"name": name, "market": market}).select(
        *keys, "parent_name"
    )
    if key == "name":
        table = table.distinct()
    rows = records.select("record_id", "raw_name", name, market)
    joined = join_lookup(
        rows, table, keys, counts=counts, max_rows=max_rows, null_safe=True, distinct=True
    )
    return joined.select(
        "record_id", "raw_name", name, "parent_name", market, F.lit(1).alias("score")
    )
