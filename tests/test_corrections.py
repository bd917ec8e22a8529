"""Corrections are applied to names where they are; beyond a bound words are shuffled, never with their names."""

import random

import pyarrow as pa
import pytest

from namekin.functions import corrections
from namekin.operators import spelling


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def fixes_of(spark, *pairs):
    return spark.createDataFrame([(a, b, 0.97) for a, b in pairs], "old_word string, new_word string, score double")


def test_names_are_corrected_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "Acme widgts"), (2, "Acme"), (3, None), (4, "widgts  widgts ")], "id int, name_clean string")
    fixed = spelling.apply_spelling(df, fixes_of(spark, ("widgts", "widgets")), output="fixed")
    assert "Exchange" not in plan_of(fixed) and "Join" not in plan_of(fixed)
    assert {r["id"]: r["fixed"] for r in fixed.collect()} == {1: "acme widgets", 2: "acme", 3: None, 4: "widgets  widgets "}


@pytest.mark.parametrize("bound", ["BROADCAST_CORRECTIONS", "BROADCAST_CHARACTERS"])
def test_beyond_the_bound_words_are_shuffled_without_their_names(spark, monkeypatch, bound):
    monkeypatch.setattr(spelling, bound, 0)
    names = spark.createDataFrame([("Acme widgts",), ("Acme",), ("x widgts abd",)], "name_clean string")
    changed = spelling.correct_names(names, fixes_of(spark, ("widgts", "widgets"), ("abd", "abc")))
    exploded = [x for x in plan_of(changed).split("\n") if "Generate explode(array_distinct" in x]
    assert exploded and not any("[name_clean" in x for x in exploded)
    assert {tuple(r) for r in changed.collect()} == {("Acme widgts", "acme widgets"), ("x widgts abd", "x widgets abc")}


@pytest.mark.parametrize("shared", [False, True])
def test_words_in_a_batch_are_replaced(monkeypatch, shared):
    if shared:  # words that share a hash are told apart
        hashes = corrections._hashes
        monkeypatch.setattr(corrections, "_hashes", lambda words: hashes(words) % 7)
    rng = random.Random(1)
    words = ["".join(rng.choice("abé01") for _ in range(rng.randint(0, 5))) for _ in range(500)]
    fixes = {w: rng.choice(words) for w in words[:150]}
    names = [None if k % 9 == 0 else " ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for k in range(400)]
    want = [None if n is None else " ".join(fixes.get(w, w) for w in n.split(" ")) for n in names]
    table = corrections.packed(pa.array(list(fixes)), pa.array(list(fixes.values())))
    assert corrections.replaced(pa.array(names), table).to_pylist() == want
    assert corrections.replaced(pa.array(names).slice(7, 50), table).to_pylist() == want[7:57]
    nothing = corrections.packed(pa.array([], pa.string()), pa.array([], pa.string()))
    assert corrections.replaced(pa.array(names), nothing).to_pylist() == names
