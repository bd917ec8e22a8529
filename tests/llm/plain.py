"""Brute-force versions of the operators, over lists of rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

SPACE = re.compile("[\x20\x09-\x0d]+")
OUTSIDE = re.compile("[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return [w for w in SPACE.split(text or "") if w]


def plain(text):
    return [w for w in OUTSIDE.split(lowered(text)) if w]


def repeat_words(words, size=5):
    grams = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    covered = set()
    for i in range(len(words) - size + 1):
        if grams[tuple(words[i : i + size])] > 1:
            covered.update(range(i, i + size))
    return len(covered)


def base_quality(text):
    words = spaced(text)
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    n, repeats = len(words), repeat_words(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeats,
        "base_failed": n < 10 or 100 * repeats > 20 * n,
    }


def shingles(text, size=2):
    words = spaced(lowered(text))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_classes(rows):
    """Component per id of ``(doc_id, text)`` rows; rows of one id are one document."""
    top = {i: i for i, _ in rows if i is not None}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            both = len(x & y)
            if both and 100 * both >= 80 * len(x | y):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return {i: find(i) for i in top}


def without_repeats(rows, run=20):
    """``(doc_id, n_words, n_removed, kept text)`` of rows in order of id (null last)."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), [None] * len(rows)
    for k in order:
        words = spaced(rows[k][1])
        gone = set()
        for s in range(len(words) - run + 1):
            gram = tuple(words[s : s + run])
            if gram in seen:
                gone.update(range(s, s + run))
            seen.add(gram)
        out[k] = (rows[k][0], len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone))
    return out


def contamination(rows, items, size=13):
    windows = {}
    for item, text in items:
        words = plain(text)
        for s in range(max(1, len(words) - size + 1)) if words else ():
            windows.setdefault(tuple(words[s : s + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words = plain(text)
        hit, found = set(), set()
        for n in lengths:
            for s in range(len(words) - n + 1):
                ids = windows.get(tuple(words[s : s + n]))
                if ids:
                    hit.update(range(s, s + n))
                    found |= ids
        joined = ",".join(sorted(map(str, found)))
        out.append({
            "doc_id": doc_id, "n_words": len(words), "n_hit": len(hit), "n_items": len(found),
            "items_sha256": hashlib.sha256(joined.encode()).hexdigest(),
            "contaminated": len(hit) > 0 and 20 * len(hit) >= len(words),
        })
    return out
