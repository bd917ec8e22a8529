"""Quality rules, licences, near duplicates, repeats and contamination against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from namekin.llm import decontaminate, license_scan, near_dedup, quality_rules, substring_dedup
from tests.llm import plain
from tests.llm.conftest import EXTRA, odd_rows, prose


def pairs(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_quality_counts(odd):
    got = quality_rules.judge(odd, ["doc_id", "text"]).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        want = plain.base_quality(r["text"])
        assert {k: r[k] for k in want} == want, r["text"]
        assert r["kept"] == (not r["base_failed"] and r["failed_rules"] == "")


def test_quality_verdicts(spark, odd, no_docs):
    rules = {r["doc_id"]: r["failed_rules"] for r in quality_rules.judge(odd, ["doc_id"]).collect()}
    assert rules[20] and "symbols" in rules[20]
    assert "repeated_lines" in rules[17]
    assert rules[18] == ""
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == quality_rules.judge(odd, ["doc_id"]).filter("kept").count()
    assert quality_rules.judge(no_docs, ["doc_id"]).count() == 0


def test_quality_runs_no_python_and_no_shuffle(odd):
    plan = quality_rules.judge(odd, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange") == 1  # that of the fixture


def test_filter_on_the_verdict_of_a_parquet_table(spark, odd, tmp_path):
    odd.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    judged = quality_rules.judge(docs, ["doc_id"])
    assert judged.filter("kept").count() + judged.filter("NOT kept").count() == len(odd_rows())
    assert quality_rules.keep_good(docs).count() == judged.filter("kept").count()


LICENSED = [
    (1, "Released under the MIT License."), (2, "apache license, version 2.0 and Apache-License version 2"),
    (3, "CC BY-NC cc by nc"), (4, "This work is licensed under the GNU General Public License, version 3."),
    (5, "mit licence apache"), (6, None), (7, ""), (None, "under the mit license"), (1, "Released under the MIT License."),
    (8, "under the mit license " * 3 + "licensed under cc by nc"), (9, "the mit license"), (10, "gnu"),
]


def test_licences(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in LICENSED], "doc_id long, text string, _found string")
    got = license_scan.scan(docs, ["doc_id", "text"]).collect()
    assert len(got) == len(LICENSED)
    for r in got:
        words = plain.plain(r["text"])
        places = [
            (k, label) for phrase, label in license_scan.KEY_PHRASES.items() for k in range(len(words))
            if words[k : k + len(phrase.split())] == phrase.split()
        ]
        assert r["n_words"] == len(words) and r["n_base"] == len(places)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert 0 <= r["score"] <= 1 and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    assert {r["labels"] for r in got if r["doc_id"] == 4} == {"gpl-3"}
    assert {r["labels"] for r in got if r["doc_id"] in (5, 9, 10)} == {""}


def test_licences_of_nothing(no_docs):
    assert license_scan.scan(no_docs, ["doc_id"]).count() == 0


@pytest.mark.parametrize("small_group", [64, 2])
def test_near_duplicates(odd, monkeypatch, small_group):
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", small_group)
    want = plain.near_classes(odd_rows())
    got = near_dedup.classes(odd).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]], r
            assert r["kept"] == (r["component_id"] == r["doc_id"])
    sizes = sorted(len(plain.shingles(t)) for _, t in odd_rows())
    assert sorted(r["n_shingles"] for r in got) == sizes


def test_no_near_duplicates_of_nothing(no_docs):
    assert near_dedup.classes(no_docs).count() == 0


def test_keep_one(odd):
    kept = near_dedup.keep_one(odd)
    want = plain.near_classes(odd_rows())
    assert kept.columns == odd.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert {i for i in ids if i is not None} == {i for i in want if want[i] == i}


def test_keep_one_row_of_each_id(spark):
    """Repeated rows go even if they are alike in nothing, null ids stay; the first text is kept with its columns."""
    rows = [(1, "b b", "x"), (1, "a a", "z"), (1, "a a", "y"), (1, None, "n"), (2, "short row", "x"), (2, "short row", "x"),
            (3, "a a", "x"), (4, None, "x"), (4, None, "x"), (None, "c c", "x"), (None, "c c", "x"), (5, prose(31, 30), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string").repartition(3)
    got = near_dedup.keep_one(docs)
    assert got.columns == docs.columns
    want = [(1, "a a", "y"), (2, "short row", "x"), (4, None, "x"), (None, "c c", "x"), (None, "c c", "x"), rows[-1]]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("small_group", [64, 2])
def test_links_that_only_a_second_look_finds(spark, monkeypatch, small_group):
    """A chain: each text is near the next, the ends are not near each other."""
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", small_group)
    words = prose(50, 200).split()
    rows = []
    for k in range(12):
        rows.append((k, " ".join(words)))
        for j in range(8):
            words[(k * 16 + 2 * j) % 200] = f"c{k}x{j}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.near_classes(rows)
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.classes(docs).collect()} == want


def test_registers_estimate_similarity_and_merge():
    rng = np.random.default_rng(1)
    pool = rng.integers(1, 1 << 63, 3000, dtype=np.uint64)
    for shared in (0, 500, 800, 1000):
        a, b = pool[:1000], np.concatenate([pool[:shared], pool[1000 : 2000 - shared]])
        true = shared / (2000 - shared)
        x, y = near_dedup.register_values(a), near_dedup.register_values(b)
        guess = near_dedup.likely_similarity(x[None], y[None], np.array([1000]), np.array([1000]))[0]
        assert abs(guess - true) < 0.08
        union = near_dedup.register_values(np.union1d(a, b))
        assert (near_dedup.merge(x, y) == union).all()


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(1, 60)] + [(100, k) for k in range(101, 160)] + [(300, 200), (300, 250), (7, 7)]
    got = near_dedup.components(spark.createDataFrame(links, "a long, b long")).collect()
    want = {k: 1 for k in range(1, 61)} | {k: 100 for k in range(100, 160)} | {200: 200, 250: 200, 300: 200}
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
    assert near_dedup.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("part_windows", [2_000_000, 100])
def test_repeats(odd, monkeypatch, part_windows):
    monkeypatch.setattr(substring_dedup, "PART_WINDOWS", part_windows)
    got = substring_dedup.without_repeats(odd).select("row.doc_id", "row.text", "n_words", "n_removed", "kept_text").collect()
    want = plain.without_repeats(odd_rows())
    # equal ids are ordered by where they were read: compare the ids that stand once
    once = {i for i in (r[0] for r in want) if [r[0] for r in want].count(i) == 1}
    assert len(got) == len(want)
    for r in (r for r in got if r["doc_id"] in once and r["doc_id"] != 22):
        assert (r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) in want, r
    total = sum(r["n_removed"] for r in got)
    assert total == sum(r[2] for r in want)


def test_repeats_in_many_groups(spark, monkeypatch):
    from namekin.llm import words

    rows = [(k, prose(k % 7, 60) + " " + prose(1000 + k, 5 + k % 40)) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = substring_dedup.without_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(plain.without_repeats(rows))
    assert words.BATCH_BYTES > 0


def test_remove_repeats_keeps_columns(odd, no_docs):
    left = substring_dedup.remove_repeats(odd)
    assert left.columns == odd.columns
    rows = {r["doc_id"]: r for r in left.collect()}
    assert 2 not in rows and rows[1]["text"] and rows[9]["text"] is None
    assert rows[6]["n_chars"] == len(rows[6]["text"]) and rows[6]["c0"] == "x"
    assert substring_dedup.without_repeats(no_docs).count() == 0


ITEMS = [
    (1, prose(1, 70)), (2, "w1 w2 w3"), (3, None), (4, ""), (5, prose(60, 30)), (6, prose(60, 30)), (7, "..."), (8, "same same same same"),
]


def test_contamination(spark, odd, no_docs):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, term string")
    rows = [*odd_rows(), (500, prose(70, 20) + " W1, w2; w3 " + prose(60, 30) + prose(71, 300))]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, term string").repartition(4)
    got = decontaminate.contamination(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated",
    ).collect()
    want = plain.contamination(rows, ITEMS)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_hit"])
    assert sorted((r.asDict() for r in got), key=key) == sorted(want, key=key)
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(not r["contaminated"] for r in want)
    no_items = items.limit(0)
    assert decontaminate.contamination(docs, no_items).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(no_docs, items).count() == 0


def test_contamination_without_broadcast(spark, odd, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    few = decontaminate.contamination(odd, items).select("doc_id", "n_hit").collect()
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert pairs(map(tuple, decontaminate.contamination(odd, items).select("doc_id", "n_hit").collect())) == pairs(map(tuple, few))


def test_proximity(spark):
    words = [f"p{k}" for k in range(13)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    mixed = words[:5] + ["extra"] + words[6:] + [words[5]]
    rows = [(1, " ".join(words)), (2, " ".join(mixed)), (3, " ".join(words[:12]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["_id"] for r in decontaminate.matches(docs, items).collect()} == {1}
    assert {r["_id"] for r in decontaminate.matches(docs, items, slack=3).collect()} == {1, 2}
