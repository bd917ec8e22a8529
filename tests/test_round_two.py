"""Salted lookups, text files with any character, nulls and repeats, scopes of scratch tables."""

import os

import pytest
from pyspark.sql import functions as F

from namekin import lists
from namekin.functions.similarity import Similarity
from namekin.operators import parents, skew, spelling
from namekin.plans.matching import Settings, match_parents
from namekin.sources import tables
from namekin.sources.scratch import scratch_path, scratch_root, scratch_scope, written

ODD = ["", "a\nb", "a\rb", "a\r\nb", "\\", "\\N", "\\n", "\\\\n", "\\r\\", "\"q\"", "tab\there", " pad ", ",", "é x", "\\\n\\", "\n"]


@pytest.mark.parametrize("form", ["csv", "delimited", "one"])
def test_text_files_keep_every_character(spark, tmp_path, form):
    rows = [(i, x, None if i % 3 == 0 else ODD[-i]) for i, x in enumerate(ODD)] + [(99, None, None)]
    schema = "n long, a string, b string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    path = str(tmp_path / form)
    if form == "csv":
        tables.write_csv(df, path)
        got = tables.read_csv(spark, path, schema)
    else:
        tables.write_delimited(df, path, single_file=form == "one")
        got = tables.read_delimited(spark, path, schema)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)


def test_many_heavy_and_long_keys_take_one_shuffle(spark, tmp_path):
    big = spark.range(4000).select(
        F.concat(F.lit("k" * 1200), (F.col("id") % 40).cast("string")).alias("k"), (F.col("id") % 100).alias("v")
    )
    big.write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    table = written(big.select("k").distinct().withColumn("w", F.length("k")), "lookup")
    counts = written(big.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "counts")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = skew.join_lookup(big, table, ["k"], counts=counts, max_rows=7, null_safe=True, distinct=True)
        want = big.join(table, "k").distinct()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
        plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans = [x for x in plan.split("\n") if "FileScan" in x and f"{tmp_path}/big" in x]
        records = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "_part#" in x]
        assert len(scans) == 1
        assert len(records) == 2  # one for either side; the distinct adds none
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_markets_are_a_market(spark):
    names = spark.createDataFrame([("a", "m", 1), ("b", None, 2)], "name string, market string, freq long")
    assert {tuple(r) for r in parents.assign_parents(names).collect()} == {("a", "m", 1, "a"), ("b", None, 2, "b")}
    rows = [(f"w{k:04d}abcdefgh", None, 1 + k % 7) for k in range(60)]
    null = spark.createDataFrame(rows, "name string, market string, freq long")
    same = null.withColumn("market", F.lit("m"))
    got, want = (sorted((r["name"], r["parent_name"]) for r in parents.assign_parents(x).collect()) for x in (null, same))
    assert got == want and any(a != b for a, b in got)


def test_corrections_apply_to_every_row_and_may_repeat(spark):
    fixes = [("abd", "abc", 0.96), ("abd", "abx", 0.97), ("abd", "aby", 0.97), (None, "x", 1.0), ("x", None, 1.0)]
    table = spark.createDataFrame(fixes, "old_word string, new_word string, score double")
    df = spark.createDataFrame([("Foo abd",), ("Foo  Bar",), ("",), (None,)], "name_clean string")
    got = {r[0] for r in spelling.apply_spelling(df, table).collect()}
    assert got == {"foo abx", "foo  bar", "", None}
    unscored = spelling.apply_spelling(df, table.drop("score"))
    assert {r[0] for r in unscored.collect()} == {"foo abc", "foo  bar", "", None}


RECORDS = "record_id string, raw_name string, market string"


def test_blank_mode_keeps_every_record(spark):
    rows = [("1", "Acme", "m"), (None, "Acme", "m"), ("3", None, "m"), ("4", "Acme", None), ("1", "Acme", "m")]
    got = match_parents(spark.createDataFrame(rows, RECORDS), Settings(nulls="blank")).collect()
    assert {(r["record_id"], r["raw_name"], r["market"]) for r in got} == {
        ("1", "Acme", "m"), (None, "Acme", "m"), ("3", "", "m"), ("4", "Acme", None)}
    assert len(got) == 4


@pytest.mark.parametrize("key", ["name", "name_market"])
def test_split_keys_change_nothing(spark, key):
    rows = [(str(k), f"Acme {'Widgets' if k % 3 else 'Widgetz'} {k % 4}", "mn"[k % 2]) for k in range(300)] * 2
    df = spark.createDataFrame(rows, RECORDS)
    plain, split = (
        sorted(map(tuple, match_parents(df, Settings(join_key=key, rng=2, max_rows_per_key=n)).collect())) for n in (10**6, 3)
    )
    assert plain == split and len(plain) >= 300


def test_all_markets_together_and_ready_corrections(spark):
    rows = [(str(k), f"globex{'x' * (k % 3)} branch", "mnop"[k % 4]) for k in range(200)]
    df = spark.createDataFrame(rows, RECORDS)
    table = spark.createDataFrame([("globexx", "globex")], "old_word string, new_word string")
    got = match_parents(
        df, Settings(per_market=False, rng=1, edge="partial", parent_similarity=Similarity(variant="notebook")), table
    ).collect()
    assert len(got) == 200
    assert {r["name_clean"] for r in got} == {"globex branch", "globexxx branch"} or all(
        "globexx " not in r["name_clean"] for r in got)
    assert len({r["parent_name"] for r in got}) == 1  # one parent over all markets


def test_scope_leaves_nothing_behind(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "x")
        frame = written(spark.range(5), "inside")
        assert frame.count() == 5 and "scope-" in path
        folder = os.path.dirname(path)
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert "scope-" not in scratch_path(spark, "x") and scratch_root(spark)


#: One name per kind of entry, with the cleaned form the production rules give (fixed values).
GOLDEN = {
    "Wal Mart Inc.": "walmart", "A T & T": "att", "7eleven": "7 11", "seven  eleven": "7 11", "Seven Eleven": "7 eleven",
    "3 m": "3m", "J P Morgan Chase": "jp morgan", "Not Provided": "", "Self Emp": "self employed", "U.S.A.F.": "us air force",
    "Amazon.com": "amazon", "Andersen": "anderson", "Albertson": "albertson", "Accountemps": "accoun temps", "Svcs": "",
    "2018 Holdings": "holdings", "agi1040": "agi", "Labs": "laboratories", "Univ of Denv": "university denver",
    "NYC Health Services": "new york", "LA Lakers": "los angeles lakers", "Market Basket": "marketing basket",
    "24hr Fitness": "24 hour fitness",
}


def test_every_list_entry_does_what_it_says(spark):
    from namekin.operators.cleaning import clean_name

    def cleaned(names):
        frame = spark.createDataFrame([(n,) for n in names], "raw string")
        return {r["raw"]: r["clean"] for r in frame.select("raw", clean_name(F.col("raw")).alias("clean")).collect()}

    assert cleaned(GOLDEN) == GOLDEN
    assert set(cleaned(lists.STOP_TOKENS).values()) <= {""} | set(lists.NAME_ALIASES.values())
    reached = cleaned([f"zq {old} zq" for old in lists.TOKEN_EXPANSIONS])
    for old, new in lists.TOKEN_EXPANSIONS.items():
        assert reached[f"zq {old} zq"] in (f"zq {new} zq", "zq zq"), old
