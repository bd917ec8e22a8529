import pytest
from pyspark.sql import functions as F

from namekin.operators import attach, skew, vocabulary
from namekin.plans.matching import Settings, match_parents
from namekin.sources import tables
from namekin.sources.scratch import CHECKPOINT_DIR, scratch_root, written
import plain_rules


def test_vocabulary_and_profile(spark):
    df = spark.createDataFrame([("a b a", 1), ("b", 3), ("", 5)], "name_clean string, n int")
    assert {r.word: r.counts for r in vocabulary.build_vocabulary(df).collect()} == {"a": 2, "b": 2}
    weighted = vocabulary.build_vocabulary(df, weight="n").collect()
    assert {r.word: r.counts for r in weighted} == {"a": 2, "b": 4}
    names = spark.createDataFrame([("x", 1500), ("y", 100), ("z", 9)], "name string, freq int")
    bands = vocabulary.profile_frequencies(names, "name", weight="freq").collect()
    assert [(r.band, r.names, r.total_freq) for r in bands] == [
        (">=1000", 1, 1500), (">=100", 2, 1600), (">=10", 2, 1600), ("<10", 1, 9)]
    assert vocabulary.table_shape(names).first() == (3, 2)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_heavy_key_lookup_equals_plain_join(spark, how):
    big = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 5).alias("v"),
    )
    table = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(30)]], "k string, w int")
    want = sorted(map(str, big.join(table, "k", how).select("k", "v", "w").collect()))
    for max_rows in (10**6, 20, 1):
        got = skew.join_lookup(big, table, ["k"], how, max_rows=max_rows).select("k", "v", "w")
        assert sorted(map(str, got.collect())) == want


def test_split_blocks_equals_plain_join(spark):
    big = spark.range(300).select((F.col("id") % 3 * F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    small = spark.range(20).select((F.col("id") % 7).alias("k"), F.col("id").alias("w"))
    want = sorted(big.join(small, "k").select("v", "w").collect())
    left, right = skew.split_blocks(big, small, "k", F.col("v"), max_rows=10)
    assert left.select("_part").distinct().count() > 1
    assert sorted(left.join(right, ["k", "_part"]).select("v", "w").collect()) == want


@pytest.mark.parametrize("key", ["name", "name_market"])
def test_attach(spark, key):
    rows = [("1", "A", "a", "m"), ("1", "A", "a", "m"), ("2", "B", "b", "m"), ("3", "", "", "n"), ("4", "Z", "z", "m")]
    records = spark.createDataFrame(rows, "record_id string, raw_name string, name_clean string, market string")
    parents = spark.createDataFrame(
        [("a", "m", "p"), ("a", "n", "q"), ("a", "o", "p"), ("b", "n", "b"), ("", "n", "")],
        "name string, market string, parent_name string")
    got = sorted(tuple(r) for r in attach.attach_parents(records, parents, key, max_rows=1).collect())
    blank = ("3", "", "", "", "n", 1)
    if key == "name_market":
        assert got == [("1", "A", "a", "p", "m", 1), blank]
    else:
        assert got == [("1", "A", "a", "p", "m", 1), ("1", "A", "a", "q", "m", 1),
                       ("2", "B", "b", "b", "m", 1), blank]


def test_text_files_keep_blanks_and_nulls_apart(spark, tmp_path):
    schema = "a string, b string, n long"
    rows = [("x", "", 1), ("", None, 2), ("q\"uo\"te", "tab\there", None), (" pad ", "a,b", 4), ("null", "nan", 5)]
    df = spark.createDataFrame(rows, schema)
    tables.write_csv(df, str(tmp_path / "csv"))
    tables.write_delimited(df.repartition(3), str(tmp_path / "tsv"))
    tables.write_delimited(df, str(tmp_path / "one"), single_file=True)
    key = lambda r: str(r)
    for got in (
        tables.read_csv(spark, str(tmp_path / "csv"), schema),
        tables.read_delimited(spark, str(tmp_path / "tsv"), schema),
        tables.read_delimited(spark, str(tmp_path / "one"), schema),
    ):
        assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(rows, key=key)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert tables.read_csv(spark, str(tmp_path / "csv"), schema, limit=2).count() == 2


def test_catalog_table(spark, tmp_path):
    df = spark.createDataFrame([("1", "Acme", "CAD", "2001-05-01"), ("2", "B", "USD", "2001-05-01"),
                                ("3", "C", "CAD", "1999-05-01")], "id string, nm string, cur string, d string")
    tables.save_table(df, "accounts", database="namekin_test", path=str(tmp_path / "accounts"))
    columns = {"record_id": "id", "raw_name": "nm", "market": "cur", "as_of": "d"}
    found = tables.read_records(spark.table("namekin_test.accounts"), columns, ["CAD"], "2001-08-01")
    assert [r.record_id for r in found.collect()] == ["1"]


def test_scratch_uses_the_session_folder(spark):
    assert scratch_root(spark).startswith(spark.conf.get(CHECKPOINT_DIR))
    df = written(spark.range(10).toDF("x"), "t")
    assert df.count() == 10 and spark.conf.get(CHECKPOINT_DIR) in df.inputFiles()[0]


def test_whole_job_corrects_and_matches(spark):
    rows = []
    for i in range(60):
        name = f"zeta works {'abcdefghij'[i % 10]}{i:02d}"
        rows += [(f"{i}-{j}", name.title(), "m") for j in range(1 + (i * 7) % 5)]
    rows += [(f"w{i}", "Zeta Worrks" if i < 2 else "Zeta Works", "m") for i in range(6)]
    rows += [("n1", None, "m"), ("b1", "!!", "m"), ("b2", "The", "k")]
    df = spark.createDataFrame(rows, "record_id string, raw_name string, market string")
    settings = Settings(min_count=20, rng=3, max_rows_per_key=3)
    got = {r.record_id: r for r in match_parents(df, settings).collect()}
    assert set(got) == {r[0] for r in rows if r[1] is not None}
    assert got["w0"].name_clean == "zeta works" and got["w0"].raw_name == "Zeta Worrks"
    assert got["b1"].parent_name == "" and got["b1"].score == 1
    freq = {}
    for r in got.values():
        if r.market == "m" and r.name_clean:
            freq[r.name_clean] = freq.get(r.name_clean, 0) + 1
    want = plain_rules.parents(list(freq.items()), 3, 0.9)
    assert all(want[r.name_clean] == r.parent_name for r in got.values() if r.name_clean)
    by_name = match_parents(df, Settings(min_count=20, rng=3, nulls="blank", join_key="name"))
    assert by_name.count() == len(rows)


def test_plans_have_no_cross_joins_and_score_once(spark):
    from namekin.functions.similarity import Similarity
    from namekin.operators.spelling import build_spelling

    vocab = spark.createDataFrame([("abcdef", 200), ("abcdeg", 1)], "word string, counts long")
    plan = build_spelling(vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("ArrowEvalPython") == 1
    assert Similarity().unmatched_budget(0.95) == pytest.approx(0.25)
