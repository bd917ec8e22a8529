"""Splitting of heavy keys and candidate pairs of long words."""

import random

import pytest
from pyspark.sql import functions as F

import plain_rules
from namekin.functions.similarity import Similarity, letter_signature
from namekin.operators import skew
from namekin.operators.blocking import candidate_pairs


@pytest.mark.parametrize("known", [False, True])
def test_only_heavy_keys_are_split(spark, known):
    """Many light keys, more than the limit allows in any number of hash buckets, and one heavy one."""
    big = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    lookup = big.select("k").distinct().withColumn("w", -F.col("k"))
    counts = big.groupBy("k").agg(F.count("*").alias("n")) if known else None
    heavy = skew._heavy_keys(counts if known else big, ["k"], 1000, "n" if known else None).collect()
    assert [r["_parts"] for r in heavy] == [10]
    joined = skew.join_lookup(big, lookup, ["k"], counts=counts, max_rows=1000)
    assert joined.agg(F.count("*"), F.sum(F.col("w") + F.col("k"))).first() == (30_000, 0)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in plan
    repeated = lookup.join(skew._heavy_keys(big, ["k"], 1000).withColumn("k", F.lit(-1)), "k").count()
    assert repeated == 1


def test_no_heavy_keys_and_empty_tables(spark):
    big = spark.range(100).select(F.col("id").alias("k"))
    assert skew._heavy_keys(big, ["k"], 1).count() == 0
    assert skew._heavy_keys(big.limit(0), ["k"], 1).count() == 0
    assert skew.join_lookup(big.limit(0), big, ["k"], max_rows=1).count() == 0


def test_blocks_are_split_on_both_sides(spark):
    big = spark.range(400).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    small = spark.range(300).select((F.col("id") % 5).alias("k"), F.col("id").alias("w"))
    want = sorted(big.join(small, "k").select("v", "w").collect())
    left, right = skew.split_blocks(big, small, "k", F.col("v"), 50, F.col("w"))
    met = left.join(right, ["k", "_part", "_other_part"])
    assert sorted(met.select("v", "w").collect()) == want
    assert left.select("k", "_part").distinct().count() == 8 and right.select("k", "_other_part").distinct().count() > 5


def words(rng, n, length, letters="abcdefghijklmnopqrstuvwxyz"):
    return ["abc" + "".join(rng.choice(letters) for _ in range(length - 3)) for _ in range(n)]


def changed(rng, word):
    word = list(word)
    for _ in range(rng.randrange(1, 5)):
        k = rng.randrange(4, len(word))
        kind = rng.randrange(3)
        if kind == 0:
            word[k] = rng.choice("abcdefgh")
        elif kind == 1:
            del word[k]
        else:
            word[k - 1], word[k] = word[k], word[k - 1]
    return "".join(word)


@pytest.mark.parametrize("length, spec, options", [
    (18, Similarity(), {}), (25, Similarity(), {}), (32, Similarity(), {}), (45, Similarity(variant="notebook"), {"notebook": True}),
    (70, Similarity(), {}),
])
def test_long_words(spark, length, spec, options):
    rng = random.Random(length)
    new = words(rng, 60, length)
    old = words(rng, 500, length) + [changed(rng, w) for w in new for _ in range(3)] + ["abc" + "é" * (length - 3), "abc" + "A1" * (length // 2)]
    left = spark.createDataFrame([(w,) for w in sorted(set(new))], "new_word string")
    right = spark.createDataFrame([(w,) for w in sorted(set(old))], "old_word string")
    got = [tuple(r) for r in candidate_pairs(left, right, "new_word", "old_word", spec, 0.95, 3, 100).collect()]
    want = {(a, b) for a in set(new) for b in set(old) if round(plain_rules.jaro_winkler(a, b, **options), 9) >= 0.95}
    assert len(want) > 30 and want <= set(got)
    assert len(got) == len(set(got)) and len(got) < 4 * len(want)


def test_signature_differs_in_no_more_bits_than_letters(spark):
    rng = random.Random(5)
    texts = ["", "a" * 20, "Éx-9 9", *["".join(rng.choice("abcxyz01 é") for _ in range(rng.randrange(30))) for _ in range(40)]]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", *[c.alias(f"s{k}") for k, c in enumerate(letter_signature("t"))]).collect()
    for x in rows:
        for y in rows:
            differing = sum((x[k] ^ y[k]).bit_count() if (x[k] ^ y[k]) >= 0 else ((x[k] ^ y[k]) & (2**64 - 1)).bit_count() for k in range(1, 5))
            apart = sum(abs(x["t"].count(c) - y["t"].count(c)) for c in set(x["t"] + y["t"]))
            assert differing <= apart
