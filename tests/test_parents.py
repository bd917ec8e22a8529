import random

import pytest
from pyspark.sql import functions as F

from namekin.functions.similarity import Similarity
from namekin.operators.parents import assign_parents
from namekin.operators.positions import with_positions
import plain_rules


def name_set(rnd, n, alphabet="ab", length=7):
    names = set()
    while len(names) < n:
        names.add("acme " + "".join(rnd.choice(alphabet) for _ in range(rnd.randint(3, length))))
    return [(x, rnd.choice([1, 1, 2, 3, 5, 8, 13, 40, 41, 42])) for x in sorted(names)]


def check(spark, markets, **options):
    rows = [(name, m, freq) for m, names in markets.items() for name, freq in names]
    df = spark.createDataFrame(rows, "name string, market string, freq long")
    got = {(r.market, r.name): r.parent_name for r in assign_parents(df, **options).collect()}
    rng, threshold = options["rng"], options["threshold"]
    want = {}
    for m, names in markets.items():
        rule = plain_rules.parents(
            [x for x in names if x[0]], rng, threshold, partial=options.get("edge") == "partial"
        )
        want.update({(m, name): p for name, p in rule.items()})
        want.update({(m, name): "" for name, _ in names if not name})
    assert got == want
    return sum(name != p for (_, name), p in got.items())


@pytest.mark.parametrize("rng,bucket,edge", [
    (2, 3, "skip"), (5, 16, "partial"), (5, 1024, "skip"),
])
def test_equals_sequential_scan(spark, rng, bucket, edge):
    rnd = random.Random(rng * 100 + bucket)
    markets = {f"m{n}": name_set(rnd, n) for n in (1, 2 * rng + 1, 2 * rng + 2, 40, 200)}
    markets["m40"].append(("", 99))
    moved = check(spark, markets, rng=rng, threshold=0.9, edge=edge, bucket_size=bucket)
    assert moved > 50


def test_long_chains_resolve(spark):
    names = [("chain" + "x" * 30 + f"{i:03d}", 1000 - i) for i in range(120)]
    assert check(spark, {"left": names}, rng=1, threshold=0.9) == 117
    rising = [("chain" + "x" * 30 + f"{i:03d}", 1 + i) for i in range(120)]
    assert check(spark, {"right": rising}, rng=1, threshold=0.9) == 117


def test_no_name_and_global_mode(spark):
    empty = spark.createDataFrame([], "name string, market string, freq long")
    assert assign_parents(empty, rng=2).collect() == []
    names = name_set(random.Random(3), 60)
    df = spark.createDataFrame(names, "name string, freq long")
    got = {r.name: r.parent_name for r in assign_parents(df, rng=3, per_market=False).collect()}
    assert got == plain_rules.parents(names, 3, 0.9)


def test_notebook_variant(spark):
    names = name_set(random.Random(4), 80)
    df = spark.createDataFrame([(a, "m", f) for a, f in names], "name string, market string, freq long")
    spec = Similarity(variant="notebook")
    got = {r.name: r.parent_name for r in assign_parents(df, 4, 0.95, spec).collect()}
    rule = lambda a, b: plain_rules.jaro_winkler(a, b, notebook=True)
    assert got == plain_rules.parents(names, 4, 0.95, similarity=rule)


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_positions_do_not_depend_on_partitions(spark, partitions):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 < 2, "big").otherwise(F.concat(F.lit("m"), F.col("id") % 7)).alias("market"),
        F.sha1(F.col("id").cast("string")).alias("name"),
    ).repartition(partitions)
    rows = with_positions(df, ["market"], ["name"]).collect()
    by_market = {}
    for r in rows:
        by_market.setdefault(r.market, []).append((r.pos, r.name, r.n))
    assert len(rows) == 5000
    for found in by_market.values():
        found.sort()
        assert [p for p, _, _ in found] == list(range(len(found)))
        assert [x for _, x, _ in found] == sorted(x for _, x, _ in found)
        assert {n for _, _, n in found} == {len(found)}


def test_rounds_read_open_rows_and_the_last_closed_ones(spark, monkeypatch):
    from namekin.operators import parents as module

    sizes = []

    def counted(df, label):
        out = written(df, label)
        sizes.append((out.count(), out.filter("open").count()))
        return out

    written = module.written
    monkeypatch.setattr(module, "written", counted)
    n = 1000
    rows = [("m", False, k, k - 1 if k else 5000, f"name{k - 1 if k else 5000}") for k in range(n)]
    rows += [("m", False, 2000 + k, 1500, "name1500") for k in range(50)]  # to a row that points nowhere
    df = spark.createDataFrame(rows, "market string, blank boolean, pos long, target_pos long, target_name string")
    got = {r["pos"]: (r["target_pos"], r["target_name"]) for r in module.follow_pointers(df).collect()}
    assert got == {k: (5000, "name5000") for k in range(n)} | {2000 + k: (1500, "name1500") for k in range(50)}
    assert len(sizes) <= 13
    for (_, open_before), (now, _) in zip(sizes, sizes[1:]):
        assert now == open_before
