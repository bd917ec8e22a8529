"""Candidate pairs of similar words, found by joining on keys that similar words must share.

Words pair only within the same prefix. Within a prefix, two words of given lengths that reach the
similarity threshold differ in at most D characters (as multisets, both sides together). Cut the
alphabet into D + A classes: in at least A classes both words have exactly the same letters. So the
letters of A classes, with the prefix and the lengths, form a join key that no qualifying pair
misses and few other pairs share. A is 1 for few differing characters and 2 for more, where a single
class has too few letters to tell words apart. What shares a key then has to pass the letter
signature, which is exact on counts, and comes once: under the first classes in which it agrees.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from namekin.functions.similarity import SIGNATURE_LETTERS, SIGNATURE_WORDS, Similarity, letter_signature
from namekin.functions.text import prefix_key
from namekin.operators.skew import MAX_ROWS_PER_KEY, split_blocks
from namekin.sources.scratch import written

#: Keys of the smaller side up to which they are broadcast, so that only words with such a key are shuffled.
BROADCAST_KEYS = 4_000_000
#: Differing characters up to which one agreeing class makes a key, and up to which two do. Pairs that may
#: differ in more are keyed by prefix and lengths alone, and left to the letter signature.
_ONE_CLASS, _TWO_CLASSES = 4, 12
# By falling frequency, so that dealing the letters out in turn gives classes of similar weight.
# Characters not listed are in no class, which costs selectivity but no pairs.
_ALPHABET = SIGNATURE_LETTERS


def block_sizes(left: DataFrame, right: DataFrame, word: str = "word", prefix: int = 3) -> DataFrame:
    """Words of either side and number of pairs per shared prefix, without forming the pairs."""
    def count(df, label):
        return df.groupBy(prefix_key(F.col(word), prefix).alias("prefix")).agg(
            F.count(F.lit(1)).alias(label)
        )

    both = count(left, "n_left").join(count(right, "n_right"), "prefix")
    return both.withColumn("n_pairs", F.col("n_left") * F.col("n_right"))


def candidate_pairs(
    left: DataFrame,
    right: DataFrame,
    left_word: str,
    right_word: str,
    similarity: Similarity = Similarity(),
    threshold: float = 0.95,
    prefix: int = 3,
    max_rows: int = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Pairs with equal prefix, every pair that reaches ``threshold`` among them, each once.

    ``left`` should be the smaller side; both hold distinct, non-empty words. Blocks with more than
    ``max_rows`` words are split on both sides.
    """
    budget = similarity.unmatched_budget(threshold) + 1e-6
    by_letters = budget < 0.9  # looser, lengths and letters rule out next to nothing
    small, big = _prepared(left, left_word, "l", prefix), _prepared(right, right_word, "r", prefix)
    if by_letters:
        small = small.withColumn("_length", F.explode(_partner_lengths(F.col("_size_l"), budget)))
        small = small.withColumn("_differing", _differing(F.col("_size_l"), F.col("_length"), budget))
        small = small.filter("_differing >= 0")
        partners = F.transform(
            _partner_lengths(F.col("_size_r"), budget), lambda other: _differing(F.col("_size_r"), other, budget)
        )
        big = big.withColumn("_length", F.col("_size_r")).withColumn("_differing", F.explode(F.array_distinct(partners)))
        small, big = _by_classes(small, "l"), _by_classes(big.filter("_differing >= 0"), "r")
        keys = ["_block", "_length", "_differing", "_combination", "_letters"]
        small, big = (x.withColumn("_key", F.xxhash64(*keys)).drop("_length", "_differing", "_letters") for x in (small, big))
        known = written(small.select("_key").distinct(), "keys")
        if known.count() <= BROADCAST_KEYS:
            big = big.join(F.broadcast(known), "_key", "left_semi")
    else:
        small, big = small.withColumn("_key", F.col("_block")), big.withColumn("_key", F.col("_block"))
    # Words of equal key have equal prefix and length, which are far cheaper to count than keys.
    if by_letters and not any(_crowded(df, word, prefix, max_rows) for df, word in ((left, left_word), (right, right_word))):
        big, small = (x.withColumns({"_part": F.lit(0), "_other_part": F.lit(0)}) for x in (big, small))
    else:
        big, small = split_blocks(
            big, small, "_key", F.col(f"`{right_word}`"), max_rows, F.col(f"`{left_word}`")
        )
    if by_letters:
        small = small.withColumnsRenamed({"_combination": "_combination_l"})
    pairs = big.join(small, ["_key", "_part", "_other_part"])

    fits = (F.col("_prefix_l") == F.col("_prefix_r")) & similarity.lengths_fit(F.col(left_word), F.col(right_word), threshold)
    if by_letters:
        lengths = F.col("_size_l"), F.col("_size_r")
        signatures = tuple([F.col(f"_s{k}_{side}") for k in range(SIGNATURE_WORDS)] for side in "lr")
        fits = fits & similarity.letters_fit(lengths, signatures, threshold) & _first_agreement()
    return pairs.filter(fits).select(*left.columns, *right.columns)


def _crowded(df: DataFrame, word: str, prefix: int, max_rows: int) -> bool:
    """Whether more than ``max_rows`` words share prefix and length."""
    value = F.col(f"`{word}`")
    return not df.groupBy(prefix_key(value, prefix), F.length(value)).count().filter(F.col("count") > max_rows).isEmpty()


def _prepared(df: DataFrame, word: str, side: str, prefix: int) -> DataFrame:
    """The words with their length, prefix, block and letter signature."""
    value = F.col(f"`{word}`")
    columns = {f"_size_{side}": F.length(value), f"_prefix_{side}": prefix_key(value, prefix)}
    columns |= {f"_s{k}_{side}": s for k, s in enumerate(letter_signature(word))}
    known = F.regexp_replace(F.substring(value, prefix + 1, 1 << 30), f"[^{_ALPHABET}]", "")
    columns["_sorted"] = F.array_join(F.sort_array(F.split(known, "")), "")
    return df.withColumns(columns).withColumn("_block", F.xxhash64(f"_prefix_{side}"))


def _differing(l1: Column, l2: Column, budget: float) -> Column:
    """Most characters that a pair of these lengths may differ in and still reach the threshold; -1 if none does.

    Beyond ``_ONE_CLASS`` rounded up to even numbers, beyond ``_TWO_CLASSES`` to one more, for fewer cases.
    """
    shorter, longer = F.greatest(F.least(l1, l2), F.lit(1)), F.greatest(l1, l2, F.lit(1))
    left_over = budget - (longer - shorter) / longer
    count = (2 * F.floor(left_over / (1.0 / shorter + 1.0 / longer)) + longer - shorter).cast("int")
    rounded = F.when(count <= _ONE_CLASS, count).when(count <= _TWO_CLASSES, count + F.pmod(count, F.lit(2)))
    return F.when(left_over < 0, -1).otherwise(F.coalesce(rounded, F.lit(_TWO_CLASSES + 1)))


def _partner_lengths(length: Column, budget: float) -> Column:
    """Lengths of the words a word of this length can be similar to."""
    low = F.greatest(F.ceil(length * (1 - budget)), F.lit(1)).cast("int")
    return F.sequence(low, F.floor(length / (1 - budget)).cast("int"))


def _schemes() -> dict[int, tuple[int, int]]:
    """Classes and how many of them must agree, by the number of differing characters."""
    one = {d: (d + 1, 1) for d in range(_ONE_CLASS + 1)}
    return one | {d: (d + 2, 2) for d in range(_ONE_CLASS + 2, _TWO_CLASSES + 1, 2)} | {_TWO_CLASSES + 1: (1, 0)}


def _by_classes(df: DataFrame, side: str) -> DataFrame:
    """One row per combination of classes, with the classes (``_combination``), a hash of their letters
    (``_letters``) and the hashes of all classes (``_codes_<side>``)."""
    # Literal tables and one translate per class; a branch per class would be too much code to compile.
    def array(items):
        return f"array({', '.join(items)})"

    others, combined = [], []
    for differing, (classes, agreeing) in _schemes().items():
        inside = [_ALPHABET[k::classes] for k in range(classes)]
        drop = ["'" + "".join(c for c in _ALPHABET if c not in x) + "'" for x in inside]
        chosen = [array(map(str, c)) if c else "CAST(array() AS array<int>)" for c in combinations(range(classes), agreeing)]
        others += [str(differing), array(drop)]
        combined += [str(differing), array(chosen)]
    codes = f"transform(map({', '.join(others)})[_differing], d -> xxhash64(translate(_sorted, d, '')))"
    of = f"xxhash64(transform(_combination, k -> get(_codes_{side}, k)))"
    rows = df.withColumn(f"_codes_{side}", F.expr(codes))
    rows = rows.withColumn("_combination", F.expr(f"explode(map({', '.join(combined)})[_differing])"))
    return rows.withColumn("_letters", F.expr(of)).drop("_sorted")


def _first_agreement() -> Column:
    """The classes of the key are the first in which the two words agree."""
    agreeing = F.filter(
        F.sequence(F.lit(0), F.size("_codes_l") - 1),
        lambda k: F.get(F.col("_codes_l"), k) == F.get(F.col("_codes_r"), k),
    )
    return F.slice(agreeing, 1, F.size("_combination")) == F.col("_combination")
