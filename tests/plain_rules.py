"""Small, slow restatements of the rules, used as brute-force oracles in tests."""

from __future__ import annotations


def jaro_winkler(a, b, *, notebook=False, winkler=True, long_tolerance=False):
    if notebook and a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    free = set(range(len(b)))
    pairs = []
    for i, ch in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1))
                  if j in free and b[j] == ch), None)
        if j is not None:
            free.discard(j)
            pairs.append((i, j))
    if not pairs:
        return 0.0
    lefts = [i for i, _ in pairs]
    rights = sorted(j for _, j in pairs)
    wrong = [i for i, j in zip(lefts, rights) if a[i] != b[j]]
    m = len(pairs)
    t = sum(2.0 ** (i - len(a)) for i in wrong) if notebook else len(wrong) // 2
    score = (m / len(a) + m / len(b) + (m - t) / m) / 3
    prefix = 0
    while prefix < min(4, len(a), len(b)) and a[prefix] == b[prefix]:
        prefix += 1
    if not winkler or (not notebook and not (score > 0.7 and min(len(a), len(b)) > 3)):
        return score
    score += 0.1 * prefix * (1 - score)
    longest = max(len(a), len(b))
    if long_tolerance and not notebook and longest > 4 and m > prefix + 1 and 2 * m >= longest + prefix:
        score += (1 - score) * (m - prefix - 1) / (len(a) + len(b) - 2 * prefix + 2)
    return score


def parents(rows, rng, threshold, partial=False, similarity=jaro_winkler):
    """Sequential scan of one market; ``rows`` are (name, freq). Returns name -> parent."""
    rows = sorted(rows)
    n = len(rows)
    parent = [name for name, _ in rows]
    for i, (name, freq) in enumerate(rows):
        if not partial and not rng <= i <= n - rng - 2:
            continue
        near = [j for j in range(max(0, i - rng), min(n, i + rng + 1)) if j != i]
        by_freq = sorted((rows[j][1] for j in near), reverse=True)
        for wanted in by_freq[:rng]:
            first = next(j for j in near if rows[j][1] == wanted)
            if wanted > freq and round(similarity(name, rows[first][0]), 9) >= threshold:
                parent[i] = parent[first]
                break
    return {name: p for (name, _), p in zip(rows, parent)}
