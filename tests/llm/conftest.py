"""Small tables with everything that may go wrong in them."""

import random

import pytest

WORDS = [f"w{k}" for k in range(400)] + "the of and to in der die und le la et de".split() * 8


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows():
    """``(doc_id, text)``: nulls, blanks, copies, near copies, shared passages, long and repeated rows."""
    passage, base = prose(1, 70), prose(2, 150)
    near = base.split()
    rows = [
        (1, base), (2, base), (3, " ".join(near[:60] + ["changed"] + near[61:])), (4, base.upper()),
        (5, prose(3, 40) + "\n" + passage), (6, passage + " " + prose(4, 60)), (7, passage),
        (8, prose(5, 30) + " " + passage[: len(passage) // 2] + " " + prose(6, 5)),
        (9, None), (10, ""), (11, " \n\t "), (12, "one"), (13, "ONE"), (14, "one two"), (15, "Two words."),
        (16, "same same same " * 30), (17, "line of words here\n" * 12), (18, prose(7, 6000)),
        (19, "é ü 漢字 ﬁ 😀 " * 20), (20, "## $$ && || " * 20), (None, base), (None, prose(8, 50)), (None, None),
        (1, base), (21, prose(9, 25)), (21, prose(10, 25)), (22, prose(9, 25)), (-5, prose(11, 45)),
        (23, "a\x1cb c\x0bd e\x0cf\x85g h i " * 4),
    ]
    rng = random.Random(5)
    for k in range(30):  # a group of near copies, each with its own change
        words = prose(99, 120).split()
        words[rng.randrange(120)] = f"own{k}"
        rows.append((100 + k, " ".join(words)))
    return rows


#: Further columns with names that the operators use inside.
EXTRA = ["_words", "n_words", "kept", "row", "gid", "c0", "body", "_row", "component_id", "_id", "node", "term", "whole"]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns, over several partitions."""
    rows = [(i, t, "en", "s", len(t or ""), *["x"] * len(EXTRA)) for i, t in odd_rows()]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)
    return spark.createDataFrame(rows, schema).repartition(3, "n_chars")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
