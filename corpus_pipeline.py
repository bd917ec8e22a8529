"""From raw documents to encoded training text: five stages, each over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from namekin.llm import decontaminate, near_dedup, piece_scan, quality_rules, substring_dedup
from namekin.sources.scratch import written


#: Words of a shingle of the near-duplicate stage. Two words are the contract of the op5 query alone.
SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dedup.keep_one(docs, SHINGLE)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; documents with nothing left go."""
    return substring_dedup.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids (little-endian 4-byte integers)."""
    return piece_scan.encode(docs)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: SQL has no SentencePiece encoder; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; what each returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
