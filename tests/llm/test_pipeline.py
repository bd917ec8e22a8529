"""The pipeline against brute force on a small fixture."""

import numpy as np
import pytest

import corpus_pipeline
from namekin.llm import piece_scan, quality_rules, tokenizers
from tests.llm import plain
from tests.llm.conftest import prose

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    item = prose(1, 30)
    rows = [(k, prose(500 + k, 80)) for k in range(20)]
    rows += [(30 + k, prose(500 + k, 80)) for k in range(5)]  # copies
    rows += [(40, prose(503, 80) + " extra"), (41, item + " " + prose(600, 40)), (42, item + " " + prose(601, 900))]
    rows += [(43, prose(700, 30) + " " + prose(505, 80) + " " + prose(701, 200)), (44, "too short"), (45, None), (46, "# $ " * 30)]
    rows += [(47, " ".join(f"e{k}" for k in range(100)))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCUMENTS)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, [(1, item), (2, None)]


def test_against_brute_force(spark, folder):
    path, rows, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    good = {r["doc_id"] for r in quality_rules.judge(docs, ["doc_id"]).filter("kept").collect()}
    assert all(plain.base_quality(t)["base_failed"] <= (i not in good) for i, t in rows)
    kept = [(i, t) for i, t in rows if i in good]
    top = plain.near_classes(kept)
    kept = sorted((i, t) for i, t in kept if top[i] == i)
    texts = {i: t for i, t in kept}
    kept = [(i, texts[i] if not gone else new) for i, n, gone, new in plain.without_repeats(kept) if not gone or gone < n]
    dirty = {r["doc_id"] for r in plain.contamination(kept, items) if r["contaminated"]}
    kept = [(i, t) for i, t in kept if i not in dirty]
    got = corpus_pipeline.run(spark, path).collect()
    library = piece_scan.Pieces(tokenizers.vocabulary(tokenizers.PIECES)).library
    assert sorted((r["doc_id"], r["text"]) for r in got) == kept
    assert all(np.frombuffer(r["ids"], "<i4").tolist() == library.encode(r["text"]) for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {41} <= dirty and 42 not in dirty


def test_stages_keep_the_columns(spark, folder):
    path, *_ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert last.columns == [*docs.columns, "ids"]


def test_nothing_in_nothing_out(spark, folder, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_duplicates_have_five_words_in_common(spark, folder):
    """Ten words changed of 200: alike by runs of two words, not by runs of five."""
    words = prose(900, 200).split()
    other = [f"own{k}" if k % 20 == 10 else w for k, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words) + " end")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCUMENTS)
    assert plain.near_classes(rows) == {1: 1, 2: 1, 3: 1}
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, folder[0]).collect()) == [1, 2]
