"""The whole job: records in, records with corrected name and parent out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from namekin.functions.similarity import Similarity
from namekin.operators.blocking import BROADCAST_KEYS
from namekin.operators.cleaning import blank_nulls, clean_names, drop_incomplete
from namekin.operators.parents import other_parents
from namekin.operators.skew import HEAVIEST, MAX_ROWS_PER_KEY, join_lookup
from namekin.operators.spelling import apply_spelling, build_spelling, corrections_of
from namekin.operators.vocabulary import build_vocabulary, name_frequency
from namekin.sources.scratch import outside_scope, scratch_scope, written


@dataclass(frozen=True)
class Settings:
    """Parameters of the whole job. Defaults are those of the production run.

    ``per_market=False`` finds parents over the names of all markets together and joins them by name.
    ``spelling_similarity`` and ``parent_similarity`` stand for ``similarity`` in one step each.
    """

    min_count: int = 100
    prefix: int = 3
    spelling_threshold: float = 0.95
    parent_threshold: float = 0.90
    rng: int = 20
    edge: str = "skip"
    nulls: str = "drop"  # or "blank": keep every record, without a name as a blank name
    join_key: str = "name_market"
    per_market: bool = True
    similarity: Similarity = Similarity()
    spelling_similarity: Similarity | None = None
    parent_similarity: Similarity | None = None
    cleaning: dict = field(default_factory=dict)
    max_rows_per_key: int = MAX_ROWS_PER_KEY


def match_parents(
    records: DataFrame, settings: Settings = Settings(), corrections: DataFrame | None = None
) -> DataFrame:
    """``(record_id, raw_name, name_clean, parent_name, market, score)`` for
    ``records (record_id, raw_name, market)``.

    Records are scanned twice: once to count cleaned names, once to attach the result, which shuffles
    them once and removes copies on the way. Everything between works on distinct names with their
    counts, which are far fewer. Names are corrected where they are, in both scans. ``corrections`` is a correction table of an earlier run; without it
    one is learned from these records.
    """
    s = settings
    rows = records.select("record_id", "raw_name", "market")
    if s.nulls == "drop":
        rows = drop_incomplete(rows)
    elif s.nulls == "blank":
        rows = blank_nulls(rows, ["raw_name"])
    else:
        raise ValueError(f"unknown null mode {s.nulls!r}")
    if s.join_key not in ("name", "name_market"):
        raise ValueError(f"unknown join key {s.join_key!r}")
    keys = ["name_corrected", "market"] if s.per_market and s.join_key == "name_market" else ["name_corrected"]
    # Tables that the result does not read are removed before the records are shuffled.
    with scratch_scope(records.sparkSession):
        counted = written(
            clean_names(rows, **s.cleaning)
            .groupBy("name_clean", "market")
            .agg(F.count(F.lit(1)).alias("n")),
            "names", "zstd",
        )
        if corrections is None:
            corrections = build_spelling(
                build_vocabulary(counted, weight="n"), s.min_count, s.spelling_threshold, s.prefix,
                s.spelling_similarity or s.similarity, s.max_rows_per_key,
            )
        with outside_scope():
            corrections = corrections_of(corrections)
        fixed = lambda df: apply_spelling(df, corrections, "name_clean", "name_corrected", s.max_rows_per_key)
        names = name_frequency(
            fixed(counted), "name_corrected", "market" if s.per_market else None, weight="n", ranged=True
        )
        positioned, others = other_parents(
            names, s.rng, s.parent_threshold, s.parent_similarity or s.similarity, s.edge, per_market=s.per_market,
        )
        # Names that are their own parent are not looked up: records meet the others only.
        others = others.withColumnRenamed("name", "name_corrected")
        if s.per_market and len(keys) == 1:
            others = _in_any_market(positioned, others)
        with outside_scope():
            others = written(others.select(*keys, "parent_name"), "others")
            counts = written(_frequent(positioned, keys, s.max_rows_per_key), "frequent")
    joined = join_lookup(
        fixed(clean_names(rows, **s.cleaning)).drop("name_clean"), others, keys, "left",
        counts=counts, max_rows=s.max_rows_per_key, null_safe=True, distinct=True,
    )
    return joined.select(
        "record_id", "raw_name", F.col("name_corrected").alias("name_clean"),
        F.coalesce("parent_name", "name_corrected").alias("parent_name"), "market", F.lit(1).alias("score"),
    )


def _frequent(positioned: DataFrame, keys: list[str], max_rows: int) -> DataFrame:
    """The keys with more than ``max_rows`` records, and their number ``n``."""
    counts = positioned.select(F.col("name").alias("name_corrected"), "market", F.col("freq").alias("n"))
    if len(keys) == 1:  # else there is a row per key already
        hashed = counts.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.sum("n").alias("n"))
        heavy = hashed.filter(F.col("n") > max_rows).orderBy(F.desc("n")).limit(HEAVIEST).select("_hash")
        counts = counts.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(heavy), "_hash", "left_semi")
        return counts.groupBy(*keys).agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") > max_rows)


def _in_any_market(positioned: DataFrame, others: DataFrame) -> DataFrame:
    """``(name_corrected, parent_name)``: the parents that the names of ``others`` have in any market; themselves too,
    if they are their own parent in one of them."""
    wanted = others.select(F.col("name_corrected").alias("name")).distinct()
    hashes = written(wanted.select(F.xxhash64("name").alias("_hash")).distinct(), "hashes")
    everywhere = positioned.select("name", F.col("market").alias("_in"))
    if hashes.count() <= BROADCAST_KEYS:  # then only the names in question are shuffled
        everywhere = everywhere.withColumn("_hash", F.xxhash64("name")).join(F.broadcast(hashes), "_hash", "left_semi").drop("_hash")
    everywhere = everywhere.join(wanted, "name", "left_semi")
    here = (F.col("name") == F.col("name_corrected")) & F.col("_in").eqNullSafe(F.col("market"))
    return everywhere.join(others.select("name_corrected", "market", "parent_name"), here, "left").select(
        F.col("name").alias("name_corrected"), F.coalesce("parent_name", "name").alias("parent_name")
    ).distinct()
