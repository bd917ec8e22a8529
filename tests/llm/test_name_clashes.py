"""Every operator and stage on tables whose further columns have the names that it uses inside."""

import ast
import inspect
import re

import corpus_pipeline
import pytest

from namekin.llm import (
    decontaminate, html_blocks, html_extract, license_scan, near_dedup, packing, piece_scan, prefix_trie, quality_model,
    quality_rules, ranked_search, substring_dedup, token_counts, toxicity, words,
)
from namekin.operators import positions, skew

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def names_inside(*modules):
    """Every name in a string of the modules: column names, schemas and SQL."""
    found = set()
    for module in (*modules, words, positions, skew):
        for node in ast.walk(ast.parse(inspect.getsource(module))):
            if isinstance(node, ast.Constant) and isinstance(node.value, str) and len(node.value) < 400:
                found |= set(re.findall(r"[A-Za-z_]\w*", node.value))
    lower = {}
    for name in sorted(found):
        lower.setdefault(name.lower(), name)
    return sorted(lower.values())


def with_names(spark, rows, schema, *modules):
    own = {c.split()[0].lower() for c in schema.split(", ")}
    extra = [n for n in names_inside(*modules) if n.lower() not in own]
    plain = spark.createDataFrame(rows, schema)
    return plain, plain.selectExpr("*", *[f"'x' AS `{n}`" for n in extra])


TEXT = " ".join(f"w{k % 37}a{k % 11}" for k in range(60))
ROWS = [
    (1, TEXT, "en", "s", 1), (2, TEXT, "en", "s", 1), (3, TEXT + " more", "en", "s", 1), (4, None, "en", "s", 1), (5, "", None, None, None),
    (None, TEXT, "en", "s", 1), (1, TEXT, "en", "s", 1), (6, "idiot words here under the MIT license " + TEXT[::-1], "en", "s", 1),
]
ITEMS = [(1, " ".join(TEXT.split()[5:25])), (2, "nothing of it")]
TURNS = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, None, None), (100, 0, "user", "a"), (105, 1, "user", "c")]
PAGES = [(1, "u", "<main><p>One text of the page, long enough to stay in it.</p></main><nav>Home</nav>"), (2, "u", None)]
LABELS = [(1, 1, 0), (2, 0, 0), (3, 1, 0), (6, 0, 1)]


@pytest.fixture(scope="session")
def items(spark):
    return with_names(spark, ITEMS, "item_id long, text string", decontaminate, ranked_search)[1]


@pytest.fixture(scope="session")
def labels(spark):
    return with_names(spark, LABELS, "doc_id long, quality int, toxic int", toxicity, quality_model)[1]


def rows_of(df):
    return sorted(map(repr, df.collect()))


OPERATORS = {
    "quality": ([quality_rules], lambda d, i, n: quality_rules.judge(d, ["doc_id"])),
    "toxicity": ([toxicity], lambda d, i, n: toxicity.score(d, toxicity.fit(d, n))),
    "near": ([near_dedup], lambda d, i, n: near_dedup.classes(d)),
    "packing": ([packing], lambda d, i, n: packing.pack(d.coalesce(1))),
    "licences": ([license_scan], lambda d, i, n: license_scan.scan(d, ["doc_id"])),
    "substring": ([substring_dedup], lambda d, i, n: substring_dedup.without_repeats(d).select("row.doc_id", "n_removed")),
    "contamination": ([decontaminate], lambda d, i, n: decontaminate.contamination(d, i)),
    "tokens": ([token_counts], lambda d, i, n: token_counts.histogram(d)),
    "search": ([ranked_search], lambda d, i, n: ranked_search.search(d, i)),
    "classifier": ([quality_model], lambda d, i, n: quality_model.classify(d, n).selectExpr("doc_id", "round(score, 6)")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, items, labels, name):
    modules, run = OPERATORS[name]
    plain, clashing = with_names(spark, ROWS, DOCS, *modules)
    assert len(clashing.columns) > len(plain.columns) + 5
    assert rows_of(run(plain, items, labels)) == rows_of(run(clashing, items, labels))


def test_pages(spark):
    plain, clashing = with_names(spark, PAGES, "page_id long, url string, html string", html_extract, html_blocks)
    assert rows_of(html_extract.extract(plain, html_extract.fit(plain))) == rows_of(html_extract.extract(clashing, html_extract.fit(clashing)))


def test_turns(spark):
    plain, clashing = with_names(spark, TURNS, "conv_id long, turn long, role string, text string", prefix_trie)
    assert rows_of(prefix_trie.trie(plain)) == rows_of(prefix_trie.trie(clashing))


STAGES = {
    "quality_rules": [quality_rules], "near_dedup": [near_dedup], "substring_dedup": [substring_dedup],
    "decontamination": [decontaminate], "sentencepiece": [piece_scan],
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_keep_such_columns(spark, tmp_path, name):
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    plain, clashing = with_names(spark, ROWS, DOCS, *STAGES[name])
    want, got = stage(spark, plain, str(tmp_path)), stage(spark, clashing, str(tmp_path))
    assert {c.lower() for c in clashing.columns} <= {c.lower() for c in got.columns}
    assert rows_of(want.select("doc_id", "text")) == rows_of(got.select("doc_id", "text"))
    assert got.filter(" OR ".join(f"`{c}` <> 'x'" for c in clashing.columns[5:] if c.lower() != "ids")).isEmpty()
