"""Joins with small tables that are broadcast up to a bound, and the same rows beyond it."""

import random

import pytest

from namekin import Settings, match_parents
from namekin.functions import text
from namekin.operators import blocking, positions, spelling
from pyspark.sql import functions as F


def names_of(spark):
    rng = random.Random(3)
    common = [w + e for w in ("international", "manufacturing", "construction") for e in ("", "al", "er")]
    rows = []
    for k in range(1500):
        words = [rng.choice(common) for _ in range(3)]
        if k % 9 == 0:  # a letter too many
            words[1] = words[1] + "x"
        rows.append((str(k), " ".join(words) + (" one" if k % 4 else ""), rng.choice(["A", "B", None, "C"])))
    return spark.createDataFrame([*rows, *rows[:20]], "record_id string, raw_name string, market string").fillna("", ["raw_name"])


def bounds(monkeypatch, most):
    for module, name in ((positions, "BROADCAST_SHIFTS"), (spelling, "BROADCAST_CORRECTIONS"), (blocking, "BROADCAST_KEYS")):
        monkeypatch.setattr(module, name, most)


@pytest.mark.parametrize("key", ["name", "name_market"])
def test_the_same_rows_beyond_the_bounds(spark, monkeypatch, key):
    rows, found = names_of(spark), []
    for most, max_rows in ((1_000_000, 1_000_000), (0, 3)):
        bounds(monkeypatch, most)
        settings = Settings(join_key=key, min_count=60, rng=3, edge="partial", max_rows_per_key=max_rows)
        found.append(sorted(map(tuple, match_parents(rows, settings).collect())))
    assert found[0] == found[1] and len({r[3] for r in found[0]}) < len({r[2] for r in found[0]})
    assert any("x" in r[1] and "x" not in r[2] for r in found[0])


def test_words_are_not_shuffled_with_their_names(spark):
    names = spark.createDataFrame([("acme widgts",), ("acme widgets",)], "name_clean string")
    fixes = spark.createDataFrame([("widgts", "widgets", 0.97)], "old_word string, new_word string, score double")
    changed = spelling.correct_names(names, fixes)
    assert "hashpartitioning(old_word" not in changed._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in changed.collect()] == [("acme widgts", "acme widgets")]


def test_looked_up_values_and_nulls(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    got = rows.select(
        text.lookup(F.col("v"), {"a": "x"}).alias("one"),
        text.expand_tokens(F.array("v", F.lit("a")), {"a": "x", "c": "y"}).alias("all"),
    ).collect()
    assert [tuple(r) for r in got] == [("x", ["x", "x"]), ("b", ["b", "x"]), (None, [None, "x"])]
