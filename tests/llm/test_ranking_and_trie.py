"""Ranked search, quality classifier and conversation trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import EXTRA, odd_rows
from hypothesis import given, settings, strategies as st

from namekin.llm import prefix_trie, quality_model, ranked_search

CLASH = [*EXTRA, "n", "terms", "tf", "rank", "score", "measures", "quality", "fold", "_part", "pos", "depth", "digest", "lead", "block"]


def with_clashes(rows, schema, spark):
    names = [c for c in CLASH if f" {c} " not in f" {schema.replace(',', ' ')} "]
    return spark.createDataFrame([(*r, *["x"] * len(names)) for r in rows], schema + "".join(f", {c} string" for c in names))


# Ranked search

def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered) if w]


def ranked(docs, items, top=20):
    bags = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    n_docs, n_terms = sum(1 for n in sizes if n), sum(sizes)
    df = Counter(t for b in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, _), bag, n in zip(docs, bags, sizes):
            if n:
                m = 75 + 25 * n * n_docs // n_terms
                total = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 12 * m))
                    for t in terms(text) if bag[t]
                )
                if total > 0:
                    scores.append((-total, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores)[:top])]
    return out


def items():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)] + ["the", "of", "one", "é", "漢字", "own3"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for k in range(25)]
    return rows + [(None, "the of"), (3, "w1 w1 w1 W2"), (70, None), (71, ""), (72, "$$$"), (73, "absent"), (74, "w5 " * 300)]


def as_key(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("block_terms, coordinates", [(1 << 17, 256), (200, 256), (1 << 17, 1)])
def test_search_against_brute_force(spark, block_terms, coordinates):
    docs = [(i, t) for i, t in odd_rows()]
    got = ranked_search.search(
        with_clashes(docs, "doc_id long, text string", spark).repartition(3),
        with_clashes(items(), "item_id long, text string", spark), coordinates=coordinates, block_terms=block_terms,
    )
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert as_key(tuple(r) for r in got.collect()) == as_key(ranked(docs, items()))


def test_search_of_nothing(spark, no_docs):
    asked = spark.createDataFrame(items(), "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame(odd_rows(), "doc_id long, text string")
    assert ranked_search.search(no_docs, asked).count() == 0
    assert ranked_search.search(docs, none).count() == 0
    assert ranked_search.search(docs, asked.filter("item_id = 70")).count() == 0


def test_bound_is_never_below_the_score():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 16, 100)
    impacts = rng.integers(1, 10**9, 60)
    places = rng.permutation(100)[:60]
    folded = ranked_search.sketch(np.zeros(60, int), cells[places], impacts, 1, 16)[0]
    exact = dict(zip(places.tolist(), impacts.tolist()))
    for _ in range(50):
        asked = rng.integers(0, 100, 12)
        assert sum(exact.get(t, 0) for t in asked.tolist()) <= folded[cells[asked]].sum()


def test_terms_of_a_very_long_text():
    text = "Word 1a2b; é漢 " * 300_000
    words = ranked_search.terms(pa.array([text, None, "", "x"]))
    assert [w for w in words[0].as_py() if w] == ["word", "1a2b", "é漢"] * 300_000
    assert [[w for w in x.as_py() if w] for x in words][1:] == [[], [], ["x"]]


# Quality classifier

def labelled():
    rng = random.Random(11)
    rows, labels = [], []
    for k in range(400):
        words = [f"w{rng.randrange(300)}" if rng.random() < 0.1 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(20, 120))]
        good = k % 4 != 0
        if not good:
            words = [w + "###" for w in words] if k % 8 else [words[0]] * len(words)
        rows.append((k, " ".join(words)))
        labels.append((k, int(good)))
    return rows, labels


def test_quality_of_held_out_rows(spark):
    rows, labels = labelled()
    rows += [(1000, None), (1001, ""), (None, "a few words here"), (7, rows[7][1]), (1002, "word " * 400_000)]
    odd_labels = [(1, 0), (None, 1), (2, None), (99999, 1), (3, 1)]
    docs = with_clashes(rows, "doc_id long, text string", spark).repartition(4)
    known = spark.createDataFrame(labels + odd_labels, "doc_id long, quality int")
    got = quality_model.classify(docs, known).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    scores = {r["doc_id"]: r["score"] for r in got}
    for k, label in labels:
        if zlib.crc32(str(k).encode()) % 5 == 0:
            assert (scores[k] >= 0.3) == bool(label), k


def test_labels_of_the_held_out_fold_are_not_used(spark):
    rows, labels = labelled()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    swapped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 5 == 0 else q) for k, q in labels]
    a, b = (
        {r["doc_id"]: round(r["score"], 9) for r in quality_model.classify(docs, spark.createDataFrame(x, "doc_id long, quality int")).collect()}
        for x in (labels, swapped)
    )
    assert a == b


def test_model_against_plain_moments(spark):
    rows, labels = labelled()
    values = quality_model.measure(pa.array([t for _, t in rows]))
    kept = [k for k, _ in labels if zlib.crc32(str(k).encode()) % 5]
    y = np.array([q for _, q in labels])
    vectors = quality_model.measured(spark.createDataFrame(rows, "doc_id long, text string"))
    found = quality_model.moments(quality_model.training_rows(vectors, spark.createDataFrame(labels, "doc_id long, quality int")))
    sums = [sum(s for (q, _), s in found.items() if q == c) for c in (0, 1)]
    model = quality_model.Model.of(sums, 0.3, 0.1)
    train, of = values[kept], y[kept]
    centre, scale = train.mean(axis=0), train.std(axis=0)
    scale[scale <= 1e-9] = 1
    z = (train - centre) / scale
    both = [np.cov(z[of == c].T, bias=True) for c in (0, 1)]
    pooled = sum((of == c).mean() * both[c] for c in (0, 1))
    log = []
    for c in (0, 1):
        s = 0.7 * both[c] + 0.3 * pooled
        s = 0.9 * s + 0.1 * np.trace(s) / len(s) * np.eye(len(s)) + quality_model.FLOOR * np.eye(len(s))
        away = (values - centre) / scale - z[of == c].mean(axis=0)
        log.append(-np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away) / 2 - np.linalg.slogdet(s)[1] / 2 + np.log((of == c).mean()))
    assert np.allclose(model.difference(values), log[1] - log[0], rtol=1e-5, atol=1e-5)


def test_measures_of_known_texts():
    at = {m: k for k, m in enumerate(quality_model.MEASURES)}
    rows = quality_model.measure(pa.array(["", None, "Aa aa b1 ##\nÉx", "x"]))
    assert rows.shape == (4, len(at)) and np.array_equal(rows[0], rows[1]) and np.isfinite(rows).all()
    assert np.isclose(rows[2, at["words"]], np.log1p(5))
    assert np.isclose(rows[2, at["distinct_words"]] ** 2, 4 / 5)
    assert np.isclose(rows[2, at["repeats_previous"]] ** 2, 1 / 5)
    assert np.isclose(rows[2, at["words_without_letter"]] ** 2, 1 / 5)
    assert np.isclose(rows[2, at["symbols"]] ** 2, 2 / 10)


@pytest.mark.parametrize("labels, score", [([], 0.5), ([(1, 1), (2, 1), (3, 1)], 1.0), ([(1, 0), (2, 0), (3, 0)], 0.0)])
def test_quality_without_both_labels(spark, no_docs, labels, score):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(5)], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    assert {r["score"] for r in quality_model.classify(docs, known).collect()} == {score}
    assert quality_model.classify(no_docs, known).count() == 0


# Conversation trie

def trie(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(c, []).append(((turn is not None, turn or 0), digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - int(math.fmod(c, 100))
        made[c] = own.get(lead, [])[:h] + turns[h:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, who in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += children[n] == 0
            saved[n[:d]] += (len(who) - 1) * len(n[-1][1]) if n else 0
    return sorted(
        (
            min(who), len(n), min(members[n[:-1]]) if n else -1, len(who), children[n], leaves[n], saved[n],
            hashlib.sha256(",".join(str(c) for c in sorted(who) if len(made[c]) == len(n)).encode()).hexdigest(),
        )
        for n, who in members.items()
    )


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in [*range(-3, 120), 200, 201, 250, 345, 399, 10**12, 10**12 + 7]:
        for k in range(rng.randrange(0, 9)):
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "ccc", None, "é漢"])))
    rows += [(400, k, "user", f"t{k // 2}") for k in range(300)]  # one very long one, and others that follow it
    rows += [(c, k, "user", f"t{k // 2}") for c in (401, 402, 403) for k in range(150)]
    rows += [(c, 0, "user", "same") for c in range(500, 640)]  # a star
    return rows + [(500, 0, "user", "same"), (None, 1, "user", "x"), (None, None, None, None)]


def trie_rows(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if c == "parent_conv_id" and r["depth"] == 0 else r[c] for c in names) for r in df.collect())


@pytest.mark.parametrize("piece, together", [(1 << 14, 1 << 20), (40, 16)])
def test_trie_against_brute_force(spark, piece, together):
    rows = conversations()
    df = with_clashes(rows, "conv_id long, turn long, role string, text string", spark).repartition(5)
    assert trie_rows(prefix_trie.trie(df, piece, together)) == trie(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(empty).count() == 0
    nameless = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(nameless).count() == 0


def test_running_hash_does_not_depend_on_blocks(spark):
    turns = spark.createDataFrame(
        [(c, d, 20, bytes([d, c % 2]), 1) for c in (1, 2, 3) for d in range(1, 21)],
        "conv_id long, depth long, length long, digest binary, points long",
    )
    a, b = (sorted(map(tuple, prefix_trie.paths(turns, block).collect())) for block in (4, 1 << 16))
    assert a == b


def test_ends_in_pieces(spark):
    steps = spark.createDataFrame(
        [(c, 1, 1, (1, c % 3)) for c in range(-50, 500)], "conv_id long, depth long, length long, node struct<a:long,b:long>"
    )
    lengths = spark.createDataFrame([(7000, 0), (-2, 0), (1, 1)], "conv_id long, length long")
    got = {(r["node"]["a"], r["node"]["b"]): r["ends_sha256"] for r in prefix_trie.ends_digests(steps, lengths, 9).collect()}
    want = {(1, k): [c for c in range(-50, 500) if c % 3 == k] for k in range(3)} | {(0, 0): [-2, 7000]}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.integers(0, 1000))
def test_component_sums(parents, seed):
    import pandas as pd

    rng = np.random.default_rng(seed)
    n = len(parents)
    parent = [-1] + [p % k for k, p in enumerate(parents[1:], 1)]
    depth, weight, n_convs = [0] * n, rng.integers(1, 5, n), None
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
    own = rng.integers(0, 10, (n, 2))
    want, under = own.copy(), weight.copy()
    for k in sorted(range(1, n), key=lambda k: -depth[k]):
        want[parent[k]] += want[k]
        under[parent[k]] += under[k]
    table = pd.DataFrame({
        "ta": 0, "tb": 0, "a": np.arange(n), "b": 0, "pa": parent, "pb": 0, "depth": depth, "n_convs": weight, "weight": under,
        "leaves": own[:, 0], "saved": own[:, 1], "more_leaves": 0, "more_saved": 0,
    })
    leaves, saved = prefix_trie.component_sums(table)
    assert np.array_equal(np.column_stack([leaves, saved]), want)
