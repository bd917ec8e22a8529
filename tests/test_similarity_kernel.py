import random

import numpy as np
import pytest

from namekin.functions import similarity
from namekin.functions.similarity import Similarity
from plain_rules import jaro_winkler

SPECS = [
    (Similarity(), {}),
    (Similarity(winkler=False), {"winkler": False}),
    (Similarity(long_tolerance=True), {"long_tolerance": True}),
    (Similarity(variant="notebook"), {"notebook": True}),
]


def random_pairs(n, longest, seed):
    rnd = random.Random(seed)
    pairs = []
    for _ in range(n):
        alphabet = rnd.choice(["ab", "abcdef", "abcdefghijklmnopqrstuvwxyz0189 "])
        a = [rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))]
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            kind = rnd.random()
            at = rnd.randint(0, len(b))
            if kind < 0.3:
                b.insert(at, rnd.choice(alphabet))
            elif kind < 0.6 and b:
                del b[at % len(b)]
            elif len(b) > 1:
                k = at % (len(b) - 1)
                b[k], b[k + 1] = b[k + 1], b[k]
        if rnd.random() < 0.2:
            b = [rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))]
        pairs.append(("".join(a), "".join(b)))
    return pairs


@pytest.mark.parametrize("spec,options", SPECS)
@pytest.mark.parametrize("longest", [5, 14, 70, 150])
def test_batch_scores_equal_plain_rule(spec, options, longest):
    pairs = random_pairs(1500 if longest < 50 else 300, longest, seed=longest)
    got = spec.score([a for a, _ in pairs], [b for _, b in pairs])
    want = [jaro_winkler(a, b, **options) for a, b in pairs]
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-12)


@pytest.mark.parametrize("spec,options", SPECS)
@pytest.mark.parametrize("longest", [65, 128, 500, 513, 2000, 2300])
def test_long_strings_equal_plain_rule(spec, options, longest):
    rnd = random.Random(longest)
    pairs = random_pairs(12, longest, seed=longest)
    for size in (longest - 1, longest, min(longest, 64)):
        text = "".join(rnd.choice("abcdefgh é漢") for _ in range(longest))
        pairs.append((text, text[: size // 2] + "".join(rnd.sample(text[size // 2 : size], size - size // 2))))
        pairs.append((text[:size], text[::-1]))
    got = spec.score([a for a, _ in pairs], [b for _, b in pairs])
    want = [jaro_winkler(a, b, **options) for a, b in pairs]
    np.testing.assert_allclose(got, want, rtol=0, atol=1e-12)


def one_pair(a, b, notebook):
    """Matches and out-of-order weight of one pair, in time linear in the lengths."""
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    waiting = {}
    for j in range(len(b) - 1, -1, -1):
        waiting.setdefault(b[j], []).append(j)
    at = []
    for i, char in enumerate(a):
        queue = waiting.get(char, [])
        while queue and queue[-1] < i - reach:
            queue.pop()
        if queue and queue[-1] <= i + reach:
            at.append((i, queue.pop()))
    found = zip([i for i, _ in at], sorted(j for _, j in at))
    return len(at), sum((0.5 ** (len(a) - i) if notebook else 1.0) for i, j in found if a[i] != b[j])


@pytest.mark.parametrize("variant", ["standard", "notebook"])
def test_very_long_strings_in_one_sweep(variant):
    rnd = random.Random(3)
    pairs = [("a" * 20_000, "a" * 19_000), ("a" * 513, "b" * 600), ("a" * 600, "ba" * 300)]
    for size in (513, 2000, 20_000):
        for letters in ("ab", "abcdefgh é漢", "".join(map(chr, range(200, 900)))):
            text = "".join(rnd.choice(letters) for _ in range(size))
            other = list(text[: size - size // 7])
            rnd.shuffle(other)
            pairs += [(text, "".join(other)), (text, text[::-1]), (text[: size // 2], text)]
    lengths = [np.array([len(p[k]) for p in pairs]) for k in (0, 1)]
    got = similarity._match_swept([a for a, _ in pairs], [b for _, b in pairs], *lengths, variant)
    want = [one_pair(a, b, variant == "notebook") for a, b in pairs]
    np.testing.assert_allclose(np.column_stack(got), want, rtol=1e-12)


def test_known_values():
    pairs = [("abcdef", "abcdefgh"), ("abcde", "abcdefghij"), ("abc", "abd"), ("", ""), ("a", "a")]
    got = Similarity().score(*map(list, zip(*pairs)))
    np.testing.assert_allclose(got, [0.95, 0.90, 0.7777777777777778, 0.0, 1.0], atol=1e-12)
    assert Similarity(variant="notebook").score([""], [""])[0] == 1.0
    assert len(Similarity().score([], [])) == 0


@pytest.mark.parametrize("spec,options", SPECS)
@pytest.mark.parametrize("threshold", [0.6, 0.72, 0.85, 0.9, 0.95])
def test_budget_never_rules_out_a_reaching_pair(spec, options, threshold):
    from collections import Counter

    budget = spec.unmatched_budget(threshold)
    for a, b in random_pairs(4000, 16, seed=7):
        if a and b and round(jaro_winkler(a, b, **options), 9) >= threshold:
            shared = sum((Counter(a) & Counter(b)).values())
            assert 2 - shared / len(a) - shared / len(b) <= budget + 1e-9, (a, b)


@pytest.mark.parametrize("spec,options", SPECS)
def test_threshold_only_drops_pairs_below_it(spec, options):
    pairs = random_pairs(800, 120, seed=5)
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    full, cut = spec.score(left, right), spec.score(left, right, 0.9)
    assert ((full == cut) | ((cut == 0) & (np.round(full, 9) < 0.9))).all()
