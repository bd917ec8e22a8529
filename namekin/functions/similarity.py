"""Jaro-Winkler scores over columns, and the exact bounds that let most pairs skip scoring.

Spark has no Jaro-Winkler built-in, so scores come from Arrow-batched pandas UDFs that score a whole
batch at a time. Callers cut the pairs first with JVM-side tests derived from the bounds here.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

# Ship the scoring code with the UDFs, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SLACK = 1e-9
_MATRIX_WIDTH = 64
# Strings up to this length are matched by bits. The work of that grows with the square of the length; beyond,
# positions are swept by character, pairs of about so many characters at a time.
_BATCH_WIDTH = 512
_SWEPT_CHARACTERS = 1 << 21
_CHUNK_CELLS = 1 << 18
# Characters counted by the letter signature: nine per 64-bit word, seven bits each.
SIGNATURE_LETTERS = "etaoinsrhldcumfpgwybvkxjqz0123456789"
_BITS, _PER_WORD = 7, 9
SIGNATURE_WORDS = len(SIGNATURE_LETTERS) // _PER_WORD


@dataclass(frozen=True)
class Similarity:
    """A Jaro-Winkler flavour.

    ``standard``: prefix bonus only above a Jaro score of 0.7 and for strings longer than 3;
    transpositions are half the out-of-order matches, rounded down; empty strings score 0.
    ``notebook``: bonus always applies, equal strings score 1, and each out-of-order match weighs
    less the further it is from the end of the first string.
    """

    variant: str = "standard"
    winkler: bool = True
    long_tolerance: bool = False

    def __post_init__(self):
        if self.variant not in ("standard", "notebook"):
            raise ValueError(f"unknown variant {self.variant!r}")

    def unmatched_budget(self, threshold: float) -> float:
        """Largest ``u1/l1 + u2/l2`` (unmatched characters over length, on both sides) that can
        still reach ``threshold``.

        Follows from Jaro <= (m/l1 + m/l2 + 1)/3 and a bonus for at most four characters.
        """
        bound = threshold - _SLACK
        if self.winkler and self.long_tolerance and self.variant == "standard":
            bound = 2 * bound - 1  # the long-string bonus closes less than half of the gap to 1
        if not self.winkler:
            jaro = bound
        elif self.variant == "notebook":
            jaro = (bound - 0.4) / 0.6
        else:
            jaro = min(bound, max(0.7, (bound - 0.4) / 0.6))
        return 3 * (1 - jaro)

    def lengths_fit(self, left: Column, right: Column, threshold: float) -> Column:
        """False only for pairs whose lengths alone keep them below ``threshold``.

        At least ``longer - shorter`` characters of the longer string stay unmatched.
        """
        return self.lengths_fit_each(F.length(left), F.length(right), threshold)

    def lengths_fit_each(self, l1: Column, l2: Column, threshold: float) -> Column:
        """The same for the lengths themselves."""
        longer = F.greatest(l1, l2)
        budget = self.unmatched_budget(threshold) + _SLACK
        return longer - F.least(l1, l2) <= longer * F.lit(budget)

    def letters_fit(
        self, lengths: tuple[Column, Column], signatures: tuple[list[Column], list[Column]], threshold: float
    ) -> Column:
        """False only for pairs whose letter counts alone keep them below ``threshold``.

        Signatures differ in at most as many bits as the strings have letters that only one of them holds.
        """
        (l1, l2), differing = lengths, F.lit(0)
        for x, y in zip(*signatures):
            differing = differing + F.bit_count(x.bitwiseXOR(y))
        budget = self.unmatched_budget(threshold) + _SLACK
        either = 1.0 / F.greatest(l1, F.lit(1)) + 1.0 / F.greatest(l2, F.lit(1))
        return (l1 + l2 - differing) * either >= 2 * (2 - budget) - _SLACK

    def score(
        self, left: list[str], right: list[str], threshold: float | None = None
    ) -> np.ndarray:
        """Scores of a batch. With a threshold, long pairs that cannot reach it may score 0."""
        budget = None if threshold is None else self.unmatched_budget(threshold)
        return _score(left, right, self, budget)

    def column(self) -> Callable[[Column | str, Column | str], Column]:
        """Function of two string columns giving their score.

        Non-deterministic to Catalyst, so a filter on the score cannot make it run twice.
        """
        spec = self

        @F.pandas_udf("double")
        def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
            return pd.Series(spec.score(left.tolist(), right.tolist()))

        return similarity.asNondeterministic()

    def reaching(self, threshold: float) -> Callable[[Column | str, Column | str], Column]:
        """Function of two string columns: whether their score reaches ``threshold``."""
        spec = self

        @F.pandas_udf("boolean")
        def similar(left: pd.Series, right: pd.Series) -> pd.Series:
            return pd.Series(reaches(spec.score(left.tolist(), right.tolist(), threshold), threshold))

        return similar.asNondeterministic()


def letter_signature(column: str) -> list[Column]:
    """How often each of ``SIGNATURE_LETTERS`` stands in the column, up to seven times, as 64-bit words: that
    many low bits of the letter's seven. Other characters are not counted."""
    def bits(k, letter):
        times = f"length(`{column}`) - length(replace(`{column}`, '{letter}', ''))"
        return f"shiftleft(shiftleft(1L, least({times}, {_BITS})) - 1L, {k * _BITS})"

    words = [SIGNATURE_LETTERS[k : k + _PER_WORD] for k in range(0, len(SIGNATURE_LETTERS), _PER_WORD)]
    return [F.expr(" | ".join(bits(k, c) for k, c in enumerate(w))) for w in words]


def reaches(score, threshold: float):
    """Threshold test on scores rounded to 9 digits; an exact 0.95 passes 0.95."""
    if isinstance(score, Column):
        return F.round(score, 9) >= threshold
    return np.round(score, 9) >= threshold


def _score(
    left: list[str], right: list[str], spec: Similarity, budget: float | None
) -> np.ndarray:
    n = len(left)
    len1 = np.fromiter(map(len, left), np.int64, n)
    len2 = np.fromiter(map(len, right), np.int64, n)
    longest = np.maximum(len1, len2)
    matches, swaps = np.zeros(n), np.zeros(n)

    live = (len1 > 0) & (len2 > 0)
    short = np.flatnonzero(live & (longest <= _MATRIX_WIDTH))
    short = short[np.argsort(longest[short], kind="stable")]
    size = max(1, _CHUNK_CELLS // _MATRIX_WIDTH)
    for start in range(0, len(short), size):
        rows = short[start : start + size]
        matches[rows], swaps[rows] = _match_matrix(
            [left[r] for r in rows], [right[r] for r in rows], len1[rows], len2[rows], spec.variant
        )
    long = np.flatnonzero(live & (longest > _MATRIX_WIDTH))
    if budget is not None and len(long):
        shared = _shared_characters([left[r] for r in long], [right[r] for r in long])
        long = long[2 - shared / len1[long] - shared / len2[long] <= budget + _SLACK]
    width = 2 * _MATRIX_WIDTH
    while width <= _BATCH_WIDTH:
        rows_of_width = long[(longest[long] <= width) & (longest[long] > width // 2)]
        size = max(1, _CHUNK_CELLS // width)
        for start in range(0, len(rows_of_width), size):
            rows = rows_of_width[start : start + size]
            matches[rows], swaps[rows] = _match_wide(
                [left[r] for r in rows], [right[r] for r in rows], len1[rows], len2[rows], spec.variant
            )
        width *= 2
    longer = long[longest[long] > _BATCH_WIDTH]
    ends = np.cumsum(len1[longer] + len2[longer])
    for part in np.split(longer, np.flatnonzero(np.diff(ends // _SWEPT_CHARACTERS)) + 1):
        if len(part):
            matches[part], swaps[part] = _match_swept(
                [left[r] for r in part], [right[r] for r in part], len1[part], len2[part], spec.variant
            )

    some = matches > 0
    m = np.where(some, matches, 1.0)
    l1, l2 = np.maximum(len1, 1), np.maximum(len2, 1)
    out_of_order = np.floor(swaps / 2) if spec.variant == "standard" else swaps
    score = np.where(some, (m / l1 + m / l2 + (m - out_of_order) / m) / 3, 0.0)

    if spec.winkler:
        prefix = _common_prefix(left, right, len1, len2)
        boosted = score + prefix * 0.1 * (1.0 - score)
        if spec.variant == "standard":
            if spec.long_tolerance:
                tolerant = (longest > 4) & (m > prefix + 1) & (2 * m >= longest + prefix)
                extra = (1.0 - boosted) * (m - prefix - 1) / (len1 + len2 - 2 * prefix + 2)
                boosted = np.where(tolerant, boosted + extra, boosted)
            allowed = (score > 0.7) & (len1 > 3) & (len2 > 3)
            score = np.where(allowed, boosted, score)
        else:
            score = np.where(some, boosted, score)
    if spec.variant == "notebook":
        equal = np.fromiter((a == b for a, b in zip(left, right)), bool, n)
        score = np.where(equal, 1.0, score)
    return score


def _codes(strings: list[str], width: int) -> np.ndarray:
    """Code points, one row per string, zero-padded; as bytes where they all fit."""
    if not strings:
        return np.zeros((0, width), np.uint8)
    codes = np.array(strings, dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)
    return codes.astype(np.uint8) if codes.max() < 256 else codes


def _common_prefix(left, right, len1, len2) -> np.ndarray:
    """Length of the common prefix, at most four."""
    a, b = _codes([s[:4] for s in left], 4), _codes([s[:4] for s in right], 4)
    inside = np.arange(4) < np.minimum(len1, len2)[:, None]
    return np.cumprod((a == b) & inside, axis=1).sum(axis=1)


def _shared_characters(left, right) -> np.ndarray:
    """No fewer than the characters both strings of a pair share, counted with repeats."""
    return np.minimum(_histograms(left), _histograms(right)).sum(axis=1)


def _histograms(strings) -> np.ndarray:
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    codes = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    cells = np.repeat(np.arange(len(strings)) * 128, lengths) + codes % 128
    return np.bincount(cells, minlength=128 * len(strings)).reshape(-1, 128)


def _match_matrix(left, right, len1, len2, variant):
    """Matched characters and out-of-order weight per pair, all pairs of a chunk in step.

    The positions of the right string are bits of one integer per pair.
    """
    n, w1 = len(left), int(len1.max())
    word = np.uint32 if len2.max() <= 32 else np.uint64
    bits = word().itemsize * 8
    a, b = _codes(left, w1), _codes(right, bits)
    one, top = word(1), word(bits - 1)
    everything = ~word(0)
    last = everything >> (top - (len2 - 1).astype(word))  # bits 0 .. len2 - 1
    reach = np.maximum(np.maximum(len1, len2) // 2 - 1, 0)
    free = last.copy()
    used1 = np.zeros((n, w1), bool)
    for i in range(w1):
        same = np.packbits(b == a[:, i, None], axis=1, bitorder="little").view(word)[:, 0]
        below = np.maximum(i - reach, 0).clip(max=bits - 1).astype(word)
        above = np.minimum(i + reach, bits - 1).astype(word)
        window = (everything << below) & (everything >> (top - above))
        nearest = same & free & window
        nearest &= ~nearest + one  # lowest set bit: the leftmost free match
        nearest[len1 <= i] = 0
        free ^= nearest
        used1[:, i] = nearest != 0
    used2 = np.unpackbits((last ^ free)[:, None].view(np.uint8), axis=1, bitorder="little")
    return _weighed(a, b, used1, used2, len1, variant)


def _weighed(a, b, used1, used2, len1, variant):
    """Matches and out-of-order weight per pair from the matched places of both sides."""
    # Row-major order lines up the k-th match of either side, as both have equally many per row.
    row, at1 = np.divmod(np.flatnonzero(used1), used1.shape[1])
    chars1, chars2 = a[used1], b[used2.astype(bool)]
    differ = np.flatnonzero(chars1 != chars2)
    weight = 0.5 ** (len1[row[differ]] - at1[differ]) if variant == "notebook" else None
    return used1.sum(axis=1), np.bincount(row[differ], weights=weight, minlength=len(a))


def _match_wide(left, right, len1, len2, variant):
    """The same with several 64-bit integers per pair, for longer strings."""
    n, w1 = len(left), int(len1.max())
    words = (int(len2.max()) + 63) // 64
    a, b = _codes(left, w1), _codes(right, 64 * words)
    rows, everything = np.arange(n), ~np.uint64(0)

    def lowest(count):
        """The lowest ``count`` bits of every row."""
        inside = np.clip(count[:, None] - 64 * np.arange(words), 0, 64)
        return np.where(inside > 0, everything >> (64 - np.maximum(inside, 1)).astype(np.uint64), np.uint64(0))

    last = lowest(len2)
    reach = np.maximum(np.maximum(len1, len2) // 2 - 1, 0)
    free = last.copy()
    used1 = np.zeros((n, w1), bool)
    for i in range(w1):
        same = np.packbits(b == a[:, i, None], axis=1, bitorder="little").view(np.uint64)
        hits = same & free & lowest(i + reach + 1) & ~lowest(i - reach)
        hits[len1 <= i] = 0
        first = (hits != 0).argmax(axis=1)  # the word with the leftmost free match, if there is any
        nearest = hits[rows, first]
        nearest &= ~nearest + np.uint64(1)
        free[rows, first] ^= nearest
        used1[:, i] = nearest != 0
    used2 = np.unpackbits((last ^ free).view(np.uint8), axis=1, bitorder="little")
    return _weighed(a, b, used1, used2, len1, variant)


def _match_swept(left, right, len1, len2, variant):
    """The same for strings of any length: positions by character, swept once for all pairs together.

    The search window only moves right, so the positions of a character are used up in order, in each string:
    a step either matches the next two or leaves one behind. All characters of all pairs step together.
    """
    reach = np.maximum(np.maximum(len1, len2) // 2 - 1, 0)
    codes, pairs, places, orders, keys = [], [], [], [], []
    for strings, lengths in ((left, len1), (right, len2)):
        codes.append(np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64))
        pairs.append(np.repeat(np.arange(len(strings)), lengths))
        places.append(np.arange(len(codes[-1])) - np.repeat(np.cumsum(lengths) - lengths, lengths))
        key = (pairs[-1] << 21) | codes[-1]
        orders.append(np.argsort(key, kind="stable"))
        keys.append(key[orders[-1]])
    p, q = places[0][orders[0]], places[1][orders[1]]
    both = np.intersect1d(*keys)
    (i, end_i), (j, end_j) = ([np.searchsorted(k, both, side) for side in ("left", "right")] for k in keys)
    window = reach[both >> 21]
    used = [np.zeros(len(c), bool) for c in codes]
    while len(i):
        ahead = q[j] - p[i]
        hit = np.abs(ahead) <= window
        used[0][orders[0][i[hit]]] = True
        used[1][orders[1][j[hit]]] = True
        i, j = i + (ahead >= -window), j + (ahead <= window)
        left_over = (i < end_i) & (j < end_j)
        if not left_over.all():
            i, j, end_i, end_j, window = (x[left_over] for x in (i, j, end_i, end_j, window))
    first, second = (np.flatnonzero(u) for u in used)
    pair, differ = pairs[0][first], codes[0][first] != codes[1][second]
    weight = differ.astype(float)
    if variant == "notebook":
        weight *= 0.5 ** np.minimum(len1[pair] - places[0][first], 1100)
    n = len(left)
    return np.bincount(pair, minlength=n).astype(float), np.bincount(pair, weights=weight, minlength=n)
