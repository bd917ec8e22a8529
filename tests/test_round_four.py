"""Names are shuffled as seldom as may be: dealt out once to be sorted and once to meet their neighbours."""

import pytest

from namekin.operators import parents, vocabulary
from namekin.operators.positions import with_positions
from namekin.plans import matching
from namekin.sources import scratch


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counted_names_are_sorted_in_their_own_shuffle(spark):
    rows = [("b", "m", 2), ("a", None, 1), ("", "m", 4), ("b", "m", 3), ("c", "k", 1), (None, "m", 9)]
    df = spark.createDataFrame(rows, "name_clean string, market string, n long")
    names = vocabulary.name_frequency(df, weight="n", ranged=True)
    assert plan_of(names.orderBy("market", "blank", "name")).count("Exchange") == 1
    placed = with_positions(names, ["market", "blank"], ["name"]).collect()
    assert {(r["name"], r["market"], r["freq"], r["pos"], r["n"]) for r in placed} == {
        ("b", "m", 5, 0, 1), ("a", None, 1, 0, 1), ("", "m", 4, 0, 1), ("c", "k", 1, 0, 1)}


def test_names_meet_their_neighbours_in_one_shuffle(spark):
    rows = [(f"acme works {k:03d}", "m", 1 + k % 5) for k in range(200)]
    placed = parents.sorted_names(spark.createDataFrame(rows, "name string, market string, freq long"))
    plan = plan_of(parents.best_neighbours(placed, 5))
    dealt = [x for x in plan.split("\n") if "Exchange hashpartitioning(market" in x]
    assert len(dealt) == 2 and sum("_bucket" in x for x in dealt) == 1  # names, and what is left of their pairs
    assert "SortMergeJoin" not in plan


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_parents_of_a_name_in_any_market(spark, monkeypatch, most):
    monkeypatch.setattr(matching, "BROADCAST_KEYS", most)
    placed = spark.createDataFrame([("a", "m"), ("a", "k"), ("a", None), ("b", "m"), ("c", None)], "name string, market string")
    others = spark.createDataFrame([("a", "m", "p"), ("a", None, "q"), ("c", None, "p")], "name_corrected string, market string, parent_name string")
    got = sorted(tuple(r) for r in matching._in_any_market(placed, others).collect())
    assert got == [("a", "a"), ("a", "p"), ("a", "q"), ("c", "p")]


def test_tables_the_result_does_not_read_are_removed(spark, monkeypatch, tmp_path):
    rows = [(str(k), f"Acme Works {k % 40:02d}" + "x" * (k % 7 == 0), None if k % 5 == 0 else "m") for k in range(300)]
    df = spark.createDataFrame(rows, "record_id string, raw_name string, market string")
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(tmp_path))
    for key in ("name", "name_market"):
        result = matching.match_parents(df, matching.Settings(min_count=20, rng=3, max_rows_per_key=4, join_key=key, nulls="blank"))
        kept = {p.parent.name.split("-")[0] for p in tmp_path.rglob("*.parquet")}
        assert kept <= {"corrections", "others", "frequent"} and "others" in kept
        assert {r["record_id"] for r in result.collect()} == {r[0] for r in rows}
