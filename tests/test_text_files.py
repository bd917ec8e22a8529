"""Text files of other writers, bad rows, one file from many tasks."""

import random

import pandas as pd
import pytest

from namekin.sources import delimited, tables

VALUES = [
    "C:\\new\\road", 'a "q" b', "line\nbreak", 'two\n\nbreaks "x"\n', "plain", "", " pad ", "x,y", "\r\nz", "\\N", '"', "\ttab", "é漢",
]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 3000)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_quoted_line_breaks_over_several_splits(spark, tmp_path, small_splits, monkeypatch, broadcast):
    monkeypatch.setattr(delimited, "BROADCAST_SPLITS", broadcast)
    rng = random.Random(1)
    rows = [(k, rng.choice(VALUES), f"m{k % 7}") for k in range(2000)]
    rows[700] = (700, "long\nvalue\n" * 2000, "m")  # over several splits by itself
    for part in range(2):
        pd.DataFrame(rows[part::2], columns=["n", "name", "m"]).to_csv(tmp_path / f"{part}.csv", index=False)
    got = tables.read_csv(spark, str(tmp_path), "n long, name string, m string")
    assert not broadcast or got.rdd.getNumPartitions() > 4
    assert sorted(map(tuple, got.collect())) == [(k, name or None, m) for k, name, m in rows]


def test_some_files_with_records_over_several_splits(spark, tmp_path):
    """The size of a split depends on all files read, so the files looked at again are split as before."""
    rows = [(k, "plain " * 20) for k in range(4000)]
    rows[100] = (100, "long\nvalue\n" * 20_000)
    for part in range(8):
        pd.DataFrame(rows[part * 500:part * 500 + 500], columns=["n", "name"]).to_csv(tmp_path / f"{part}.csv", index=False)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = sorted(map(tuple, tables.read_csv(spark, str(tmp_path), "n long, name string").collect()))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == rows


def test_bad_rows(spark, tmp_path):
    text = '\ufeffn,a\r\n1,x\r\n2\r\n3,y,z\r\n\r\nw,q\r\n4,"long\r\nvalue"\r\n5,""\r\n6,"open\r\n7,x'
    (tmp_path / "b.csv").write_text(text, newline="")
    read = tables.read_csv(spark, str(tmp_path / "b.csv"), "n int, a string", bad_rows="column")
    assert sorted(map(tuple, tables.good_rows(read).collect())) == [(1, "x"), (4, "long\r\nvalue"), (5, "")]
    assert sorted(r["record"] for r in tables.rejected(read).collect()) == ["2", "3,y,z", '6,"open\r\n7,x', "w,q"]
    assert [r["n"] for r in tables.reject_counts(read).collect()] == [4]
    with pytest.raises(Exception, match="bad row"):
        tables.read_csv(spark, str(tmp_path / "b.csv"), "n int, a string").select("n").collect()


def test_files_without_quoting(spark, tmp_path):
    (tmp_path / "h.tsv").write_text('1\t"ACME\t\\N\n2\tx"y"\t\n3\t\\N\tz\n')
    got = tables.read_delimited(spark, str(tmp_path), "n int, a string, b string", quote=None, null_text="\\N")
    assert sorted(map(tuple, got.collect())) == [(1, '"ACME', None), (2, 'x"y"', ""), (3, None, "z")]


@pytest.mark.parametrize("single", [False, True])
def test_one_column_with_nulls(spark, tmp_path, single):
    rows = [(None,), ("",), ("a",), ("b\nc",)]
    tables.write_delimited(spark.createDataFrame(rows, "a string").coalesce(2), str(tmp_path / "x"), single_file=single)
    got = tables.read_delimited(spark, str(tmp_path / "x"), "a string").collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, rows))


def test_one_file_keeps_the_order_of_its_parts(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id", "concat('x', id) AS x").repartitionByRange(9, "id").sortWithinPartitions("id")
    path = tmp_path / "one"
    for _ in range(2):  # the second time it is replaced
        tables.write_delimited(rows, str(path), ",", single_file=True)
    files = [p.name for p in path.iterdir() if p.name.startswith("part-")]
    assert files == ["part-00000.csv"] and rows.rdd.getNumPartitions() == 9
    assert (path / files[0]).read_text() == "".join(f"{k},x{k}\n" for k in range(5000))
    assert [p.name for p in tmp_path.iterdir()] == ["one"]
    tables.write_delimited(rows.limit(0), str(path), single_file=True)
    assert tables.read_delimited(spark, str(path), "id long, x string").count() == 0
