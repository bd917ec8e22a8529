"""The second look of the near-duplicate operator in large groups."""

import random

import pytest
from pyspark.sql import functions as F

from namekin.llm import near_dedup


def top_of(links, n):
    top = list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        top[y] = x
    return [find(i) for i in range(n)]


def sets_of_a_group(seed, n):
    """Sets around one template, some around templates of their own within it, some linked, most not."""
    rng = random.Random(seed)
    template = set(range(100))
    inner = [set(range(1000 + 50 * k, 1000 + 50 * k + rng.randrange(10, 40))) for k in range(4)]
    out = []
    for _ in range(n):
        if out and rng.random() < 0.3:
            base = set(rng.choice(out))
            spare = rng.sample(sorted(base), rng.randrange(0, len(base) // 6))
            base -= set(spare[: len(spare) // 2])
            base |= {rng.randrange(10**6, 10**9) for _ in spare[len(spare) // 2 :]}
        else:
            base = template - set(rng.sample(sorted(template), rng.randrange(0, 20)))
            base |= rng.choice(inner) if rng.random() < 0.5 else set()
            base |= {rng.randrange(5000, 5400) for _ in range(rng.randrange(0, 60))}
        out.append(base)
    return out


def linked(x, y):
    both = len(x & y)
    return 100 * both >= near_dedup.PERCENT * (len(x) + len(y) - both)


@pytest.mark.parametrize("seed, n", [(1, 60), (2, 120)])
def test_groups_lose_no_link(spark, seed, n):
    sets = sets_of_a_group(seed, n)
    pivot = sets[0]
    rows = [(7, k, k, len(x), [int(e) for e in x ^ pivot]) for k, x in enumerate(sets)]
    groups = spark.createDataFrame(rows, "g long, b long, c long, n long, diff array<long>")
    found = {tuple(r) for part in near_dedup._pairs_within(groups) for r in part.collect()}
    links = [(a, b) for b in range(n) for a in range(b) if linked(sets[a], sets[b])]
    assert len(links) > n // 8
    assert top_of([p for p in found if linked(sets[p[0]], sets[p[1]])], n) == top_of(links, n)


def test_members_of_one_template_do_not_meet(spark):
    def pairs(n):
        rng = random.Random(n)
        sets = [set(range(100)) | {rng.randrange(10**3, 10**9) for _ in range(30)} for _ in range(n)]
        rows = [(7, k, k, 130, [int(e) for e in x ^ sets[0]]) for k, x in enumerate(sets)]
        groups = spark.createDataFrame(rows, "g long, b long, c long, n long, diff array<long>")
        return sum(part.count() for part in near_dedup._pairs_within(groups))

    assert pairs(100) + pairs(400) == 0


def test_documents_of_one_template(spark):
    rng = random.Random(4)
    template = [f"t{k}" for k in range(150)]
    rows = [(k, " ".join(template + [f"v{rng.randrange(5000)}" for _ in range(50)])) for k in range(150)]
    near = rows[70][1].split()
    rows += [(1000 + k, " ".join(near[:150] + [f"x{k}"] + near[151:])) for k in range(40)]
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    sizes = {r["component_id"]: r["n"] for r in got.groupBy("component_id").agg(F.count("*").alias("n")).collect()}
    assert sizes.pop(70) == 41 and set(sizes.values()) == {1}
