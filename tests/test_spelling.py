import random

import pytest
from pyspark.sql import functions as F

from namekin.functions.similarity import Similarity
from namekin.operators.blocking import candidate_pairs
from namekin.operators.spelling import apply_spelling, build_spelling
import plain_rules


def word_set(seed, n=400):
    rnd = random.Random(seed)
    words = {}
    while len(words) < n:
        stem = rnd.choice(["abc", "abd", "ab", "a", "customer", "xyz" + "q" * 25])
        word = stem + "".join(rnd.choice("abc01") for _ in range(rnd.randint(0, 9)))
        words[word] = rnd.choice([1, 5, 99, 100, 100, 500])
        if rnd.random() < 0.6 and len(word) > 4:
            k = rnd.randint(3, len(word) - 1)
            words.setdefault(word[:k] + word[k + 1 :], 1)
            words.setdefault(word[:k] + rnd.choice("abc01") + word[k:], 100)
    return words


@pytest.mark.parametrize("threshold,spec,options", [
    (0.95, Similarity(), {}),
    (0.9, Similarity(), {}),
    (0.95, Similarity(variant="notebook"), {"notebook": True}),
    (0.75, Similarity(winkler=False), {"winkler": False}),
    (0.6, Similarity(long_tolerance=True), {"long_tolerance": True}),
])
def test_blocking_misses_no_pair(spark, threshold, spec, options):
    words = word_set(1)
    df = spark.createDataFrame(list(words.items()), "word string, counts int")
    left = df.filter("counts >= 100").select(F.col("word").alias("new_word"))
    right = df.filter("counts < 100").select(F.col("word").alias("old_word"))
    for max_rows in (10**6, 5):
        found = candidate_pairs(left, right, "new_word", "old_word", spec, threshold, 3, max_rows)
        got = [(r.new_word, r.old_word) for r in found.collect()]
        want = {
            (a, b)
            for a, ca in words.items() if ca >= 100
            for b, cb in words.items() if cb < 100
            if a[:3] == b[:3] and round(plain_rules.jaro_winkler(a, b, **options), 9) >= threshold
        }
        assert want <= set(got)
        assert all(a[:3] == b[:3] for a, b in got)
        if max_rows == 5 and threshold < 0.95:
            break


def test_spelling_table_equals_plain_rule(spark):
    words = word_set(2)
    vocabulary = spark.createDataFrame([*words.items(), ("", 3)], "word string, counts int")
    got = {r.old_word: (r.new_word, round(r.score, 9)) for r in build_spelling(vocabulary).collect()}
    want = {}
    for old, count in words.items():
        if count >= 100:
            continue
        scored = [
            (-round(plain_rules.jaro_winkler(new, old), 9), -c, new)
            for new, c in words.items() if c >= 100 and new[:3] == old[:3]
        ]
        if scored and -min(scored)[0] >= 0.95:
            want[old] = (min(scored)[2], -min(scored)[0])
    assert got == want and len(want) > 20


@pytest.mark.parametrize("max_rows", [10**6, 2])
def test_correction_keeps_every_row(spark, max_rows):
    names = ["abd foo", "foo", "", "abd abd x", "x abe", "foo", "foo", "foo", "abd foo", "abd foo", "abd foo"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, name_clean string")
    spelling = spark.createDataFrame(
        [("abd", "abc", 0.95), ("abe", "abc", 0.95)], "old_word string, new_word string, score double"
    )
    got = {r.id: r.name_clean for r in apply_spelling(df, spelling, max_rows=max_rows).collect()}
    fix = {"abd": "abc", "abe": "abc"}
    assert got == {i: " ".join(fix.get(w, w) for w in n.split()) for i, n in enumerate(names)}
    both = apply_spelling(df, spelling, output="fixed", max_rows=max_rows)
    assert both.columns == ["id", "name_clean", "fixed"] and both.count() == len(names)
