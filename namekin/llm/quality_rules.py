"""Quality rules: a table of thresholds compiled into one projection.

All measures of a text are built-in expressions over its row: no user function, no shuffle, no
state beyond the row. Repeated windows are found by hashing every window, and only texts whose hashes
are not all different sort them.

Defined cases: a null or blank text has no words and fails the base rule; ratios over nothing are 0;
rows are judged one by one, so repeated ids, repeated rows and null ids change nothing; an empty table
gives an empty result; further columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from namekin.llm.words import SPACE_RUN, spaced_words, whole

#: Frequent function words of the languages served.
STOP_WORDS = (
    "the and of to in is that it for was on are as with this by be at or an a from "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als "
    "le la les de des du et en un une que qui dans pour par sur au est il elle "
    "el los las y que en un una por con para se del al lo su"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` for texts of at least ``min_words`` words."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


#: Ratios are per word, but ``upper_ratio`` per word character and ``dup_line_ratio`` per line.
RULES = (
    Rule("word_length", "word_length", 1.5, 20.0),
    Rule("symbols", "symbol_ratio", high=0.2),
    Rule("capitals", "upper_ratio", high=0.5),
    Rule("stop_words", "stop_ratio", low=0.01, min_words=100),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def _ratio(part: str, of: str) -> Column:
    return F.when(F.col(of) > 0, F.col(part) / F.col(of)).otherwise(F.lit(0.0))


#: Numerator and denominator of each ratio.
MEASURES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_ratio": ("n_symbols", "n_words"),
    "upper_ratio": ("n_upper", "word_chars"),
    "stop_ratio": ("n_stop_words", "n_words"),
    "dup_line_ratio": ("n_dup_lines", "n_lines"),
}


def _removed(text: Column, pattern: str) -> Column:
    """Characters of the text that match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _fails(rule: Rule) -> Column:
    value = _ratio(*MEASURES[rule.measure])
    out = F.lit(False)
    if rule.low is not None:
        out = out | (value < rule.low)
    if rule.high is not None:
        out = out | (value > rule.high)
    return out & (F.col("n_words") >= rule.min_words)


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` and the counts the rules are made of."""
    body = whole(text)
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE_RUN, "")) > 0)
    rows = docs.select(
        *keep, body.alias("_body"), spaced_words(F.col(text)).alias("_words"), lines.alias("_lines")
    )
    n = F.size("_words")
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice("_words", i, WINDOW))
    )).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        *keep,
        n.cast("long").alias("n_words"),
        (F.length("_body") - _removed(F.col("_body"), SPACE_RUN)).cast("long").alias("word_chars"),
        _removed(F.col("_body"), "[#*$%&|<>]").cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.regexp_count("_body", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        hashes.alias("_hashes"),
    )
    placed = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    none = F.array().cast("array<struct<h:bigint,at:int>>")
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(placed)).otherwise(none))

    def twice(x, i):
        near = lambda j: F.coalesce(F.get("_sorted", j)["h"] == x["h"], F.lit(False))
        return near(i - 1) | near(i + 1)

    starts = F.sort_array(F.transform(F.filter("_sorted", twice), lambda x: x["at"]))
    rows = rows.withColumn("_starts", starts).drop("_hashes", "_sorted")
    reach = F.transform(
        "_starts", lambda s, i: F.least(F.lit(WINDOW), F.get("_starts", i + 1) - s)
    )
    covered = F.aggregate(reach, F.lit(0), lambda total, x: total + x)
    return rows.withColumn("n_repeat_words", covered.cast("long")).drop("_starts")


def judge(
    docs: DataFrame, keep: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``failed_rules`` (comma-joined) and ``kept``."""
    # A filter on the verdict is not moved below a column that depends on the row's place: moved into
    # the scan, it would hold every measure many times over.
    rows = measured(docs, keep, text).withColumn("_place", F.monotonically_increasing_id())
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    base = base & (F.col("_place") >= 0)
    failed = F.concat_ws(",", *[F.when(_fails(r), F.lit(r.name)) for r in rules])
    return rows.withColumns({"base_failed": base, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed_rules") == "")
    ).drop("_place")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns only."""
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    judged = judge(docs.select(whole_row, F.col("text")), ["_row"], "text", rules)
    return judged.filter("kept").select("_row.*")
