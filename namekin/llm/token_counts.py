"""Token counts for every context limit from an exact histogram of document lengths.

Tasks count their documents by encoded length, so what is shuffled is one row per length and task.
Sums over all longer documents then answer totals, quantiles and truncated totals for any limit.

Defined cases: a null or blank text has length 0; rows are counted one by one, repeated ones too; an
empty table gives an empty histogram; only ``text`` is read.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from namekin.llm import tokenizers
from namekin.llm.words import slices
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lengths per bucket of the suffix sums.
BUCKET = 4096


def histogram(
    docs: DataFrame, folder: str = tokenizers.FOLDER, vocabulary: str = tokenizers.BYTE_BPE
) -> DataFrame:
    """``(n_tokens, n_docs)``: documents by encoded length."""
    data = tokenizers.vocabulary(vocabulary, folder)

    def count(batches):
        encoder = tokenizers.byte_encoder(data)
        for whole in batches:
            seen = Counter()
            for batch in slices(whole):
                for text in batch.column("text").to_pylist():
                    seen[len(encoder.encode_to_numpy(text, disallowed_special=())) if text else 0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())],
                names=["n_tokens", "n_docs"],
            )

    counted = docs.select("text").mapInArrow(count, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def length_table(lengths: DataFrame) -> DataFrame:
    """Per length L that occurs: documents and tokens of length L or more, the total if every document
    is cut at L (``truncated_total``), and the share of documents of length L or less (``quantile``).

    Sums run within buckets of lengths and over bucket totals, so no task holds all lengths. The
    histogram is written first: it is read twice, and encoding the texts twice would cost far more.
    """
    rows = written(lengths, "lengths").select(
        "n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("n_tokens") / BUCKET).alias("bucket"),
    )
    totals = rows.groupBy("bucket").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # one row per 4096 lengths: a document of a million tokens adds at most 250 rows
    after = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "bucket", F.coalesce(F.sum("d").over(after), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(after), F.lit(0)).alias("t_after"),
        F.sum("d").over(Window.partitionBy(F.lit(1))).alias("all_docs"),
        F.sum("t").over(Window.partitionBy(F.lit(1))).alias("all_tokens"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("n_tokens")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    joined = rows.join(totals, "bucket").withColumns({
        "docs_from": F.sum("n_docs").over(inside) + F.col("d_after"),
        "tokens_from": F.sum("tokens").over(inside) + F.col("t_after"),
    })
    cut = F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
    return joined.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from", cut.alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("n_docs")) / F.col("all_docs")).alias("quantile"),
    )


def at_limits(lengths: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Per context limit: documents, whole documents, all tokens and tokens left when cut there."""
    limit = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    rows = lengths.select("n_tokens", "n_docs", limit)
    n = F.col("n_docs")
    return rows.groupBy("limit").agg(
        F.sum("n_docs").alias("n_docs"),
        F.sum(F.when(F.col("n_tokens") <= F.col("limit"), n).otherwise(0)).alias("n_whole"),
        F.sum(F.col("n_tokens") * n).alias("total"),
        F.sum(F.least("n_tokens", "limit") * n).alias("truncated_total"),
    )


def quantiles(lengths: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per share: the least length that this share of the documents does not exceed."""
    table = length_table(lengths)
    return table.select("n_tokens", "quantile", F.explode(F.array(*map(F.lit, shares))).alias("share")).filter(
        F.col("quantile") >= F.col("share")
    ).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))
