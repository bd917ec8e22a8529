"""Near-duplicate documents by SetSketch registers.

A document's set holds its distinct word shingles. A register keeps the minimum of an exponential
hash over the set, truncated to powers of ``BASE``; equal registers of two sets have about their Jaccard
similarity as probability, and the register-wise maximum is the sketch of the union.

1. One pass sketches every document. Documents with equal sets form a class; only the one with the
   smallest id, its representative, goes on.
2. Bands of register values are hashed to buckets. Within a bucket every member is compared with the
   smallest id there, so a bucket of any size gives one pair per member.
3. Pairs are first estimated by joint likelihood of their registers, then confirmed on the full sets.
4. Confirmed links give components. The members compared with one document form its group. Groups that
   still hold several components are looked at once more, across components only, so no link is lost
   to the choice of step 2. Up to ``SMALL_GROUP`` members all pairs are compared. In a larger group exact bounds
   on shared differences first take out whoever is linked to nobody, as are members that only have a
   template in common, and connect what lies around the centre; the rest is compared in blocks
   (see ``_pairs_within``).

At similarity 0.8 a pair shares no band with probability ``(1 - 0.8**8)**80``, about 4e-7.

Defined cases: null or blank texts have an empty set and stay alone; fewer words than a shingle make
one shingle of all words; a repeated id is one document with the links of all its rows; a row with a
null id is kept and not linked (``component_id`` null); an empty table gives an empty result; only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from namekin.llm.words import (
    hash_windows, hash_words, mixed, slices, small_enough, text_bytes, within_texts, word_bounds,
)
from namekin.operators.skew import join_lookup
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a shingle where a caller names no other size, as in op5.
SHINGLE = 2
PERCENT = 80
BANDS, ROWS = 80, 8
REGISTERS = BANDS * ROWS
ESTIMATE_REGISTERS = 128
BASE, RATE, TOP = 1.001, 20.0, 65534
#: Pairs estimated this far below the threshold (six standard deviations) are not confirmed.
MARGIN = 0.22
#: Members of a group up to which all pairs across components are compared.
SMALL_GROUP = 8
#: Members, their listed elements, and columns of a block that are compared by one matrix product.
TOGETHER, ELEMENTS_TOGETHER, COLUMNS_TOGETHER = 400, 1 << 17, 1 << 10
#: Sets of n and m elements are linked if FAR times the elements in only one is at most NEAR times n + m.
NEAR, FAR = 100 - PERCENT, 100 + PERCENT
#: Largest set of ids that is broadcast to pick texts.
BROADCAST_IDS = 1_000_000

_RANDOM = np.random.default_rng(77)
_MULTIPLY = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_FLIP = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_BAND_CODES = _RANDOM.integers(1, 1 << 63, REGISTERS, dtype=np.uint64) | np.uint64(1)

SKETCH_SCHEMA = "doc_id long, n_shingles long, d1 long, d2 long, registers binary, bands array<long>"


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of every text, A-Z lower-cased."""
    data, offsets = text_bytes(texts)
    starts, ends, before = word_bounds(data, offsets)
    words = hash_words(data, starts, ends, lower=True)
    windows = hash_windows(words, size)
    windows = np.where(within_texts(before, size), windows, np.uint64(0))
    for first, last in zip(before[:-1], before[1:]):
        if last - first >= size:
            yield np.unique(windows[first : last - size + 1])
        elif last > first:
            short = words[first:last] * np.arange(3, 3 + 2 * (last - first), 2, dtype=np.uint64)
            yield mixed(np.array([short.sum(dtype=np.uint64)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def register_values(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set of 64-bit hashes."""
    low = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for first in range(0, len(short), 256):
        part = (short[first : first + 256, None] ^ _FLIP) * _MULTIPLY
        np.minimum(low, part.min(axis=0), out=low)
    exponential = -np.log1p(-(low.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(left, right)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; equal for equal register values of the same band."""
    weighted = (registers.astype(np.uint64) + np.uint64(1)) * _BAND_CODES
    keys = weighted.reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return mixed(keys + np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def likely_similarity(
    left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray
) -> np.ndarray:
    """Similarity of greatest likelihood for pairs of sketches (rows), given their set sizes.

    Follows from how often the left register is larger, smaller or equal; searched on a grid.
    """
    more = (left > right).sum(axis=1)[:, None]
    less = (left < right).sum(axis=1)[:, None]
    same = left.shape[1] - more - less
    u = (n_left / (n_left + n_right))[:, None]
    v = 1 - u
    grid = np.minimum(np.linspace(0, 1, 101)[None, :], np.minimum(u / v, v / u))

    def chance(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = chance(u - v * grid), chance(v - u * grid)
    tiny = 1e-12
    likelihood = (
        more * np.log(above + tiny) + less * np.log(below + tiny)
        + same * np.log(np.maximum(1 - above - below, tiny))
    )
    return np.take_along_axis(grid, likelihood.argmax(axis=1)[:, None], axis=1)[:, 0]


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Size, digest, first registers and band keys of every document's set."""

    def sketch(batches):
        none = np.zeros(0, np.int64)
        for whole in batches:
            for batch in slices(whole):
                n, digest, registers, bands = [], [], [], []
                for shingles in shingle_sets(batch.column("text"), size):
                    n.append(len(shingles))
                    digest.append((
                        shingles.sum(dtype=np.uint64), mixed(shingles).sum(dtype=np.uint64)
                    ))
                    if len(shingles):
                        values = register_values(shingles)
                        registers.append(values[:ESTIMATE_REGISTERS].tobytes())
                        bands.append(band_keys(values).view(np.int64))
                    else:
                        registers.append(b"")
                        bands.append(none)
                digest = np.array(digest, np.uint64).view(np.int64).reshape(-1, 2)
                ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]), pa.array(registers, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(bands))),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "registers", "bands"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sketch, SKETCH_SCHEMA)


def _estimated(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that may be similar by their registers and set sizes."""
    side = lambda s: members.select(
        F.col("doc_id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}")
    )
    fits = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    joined = pairs.join(side("a"), "a").join(side("b"), "b").filter(fits)

    def estimate(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                for c in ("r_a", "r_b")
            )
            n_left, n_right = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            good = likely_similarity(left, right, n_left, n_right) >= PERCENT / 100 - MARGIN
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return joined.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(estimate, "a long, b long")


def _with_texts(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """``(a, b, t_a, t_b)`` for a written table of pairs ``(a, b)``."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "doc_id")
    wanted = small_enough(written(wanted, "wanted"), BROADCAST_IDS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        wanted, "doc_id", "left_semi"
    )
    side = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"t_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough. ``pairs`` should be a written table."""
    def confirm(batches):
        for whole in batches:
            for batch in slices(whole, "t_b"):
                left, right = (shingle_sets(batch.column(c), size) for c in ("t_a", "t_b"))
                good = [
                    100 * (both := len(np.intersect1d(x, y, assume_unique=True)))
                    >= PERCENT * (len(x) + len(y) - both)
                    for x, y in zip(left, right)
                ]
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return _with_texts(pairs, docs).mapInArrow(confirm, "a long, b long").distinct()


def differences(pairs: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(a, b, n, diff)``: size of the set of b, and the shingles that only one of a and b holds."""
    def differ(batches):
        for whole in batches:
            for batch in slices(whole, "t_b"):
                sets = list(zip(*(shingle_sets(batch.column(c), size) for c in ("t_a", "t_b"))))
                diff = [np.setxor1d(x, y, assume_unique=True).view(np.int64) for x, y in sets]
                ends = np.cumsum([0, *map(len, diff)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("a"), batch.column("b"), pa.array([len(y) for _, y in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(diff))),
                    ],
                    names=["a", "b", "n", "diff"],
                )

    return _with_texts(pairs, docs).mapInArrow(differ, "a long, b long, n long, diff array<long>")


def _pairs_across(stars: DataFrame, found: DataFrame, docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """Pairs ``(a, b)`` of different components that share a group of ``stars (a, b)``."""
    of = found.select(F.col("node").alias("b"), F.col("component"))
    members = stars.join(of, "b", "left").withColumn("c", F.coalesce("component", "b"))
    members = _mixed(members.select(F.col("a").alias("g"), "b", "c"))
    large = members.filter(F.col("size") > SMALL_GROUP)
    pairs = [written(_all_pairs(members.filter(F.col("size") <= SMALL_GROUP)), "across")]
    if not large.isEmpty():
        diffs = differences(written(large.select(F.col("g").alias("a"), "b"), "group-pairs"), docs, size)
        groups = diffs.withColumnRenamed("a", "g").join(large, ["g", "b"])
        pairs += _pairs_within(written(groups.select(*GROUP), "groups"))
    return reduce(DataFrame.union, pairs).distinct()


GROUP = ["g", "b", "c", "n", "diff"]


def _mixed(members: DataFrame) -> DataFrame:
    """``members (g, b, c)`` of the groups that hold several components, with the group's ``size``, written."""
    sizes = members.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("low"), F.max("c").alias("high"))
    sizes = written(sizes.filter("low < high").select("g", "size"), "sizes")
    return written(join_lookup(members, sizes, ["g"], counts=sizes, weight="size"), "members")


def _all_pairs(small: DataFrame) -> DataFrame:
    """All pairs of different components in groups of at most ``SMALL_GROUP``."""
    x, y = small.select("g", "b", "c").alias("x"), small.select("g", "b", "c").alias("y")
    met = x.join(y, F.expr("x.g = y.g AND x.b < y.b AND x.c <> y.c"))
    return met.select(F.col("x.b").alias("a"), F.col("y.b").alias("b"))


def _pairs_within(groups: DataFrame) -> list[DataFrame]:
    """Pairs ``(a, b)`` of members of large groups ``(g, b, c, n, diff)`` that connect all that are linked.

    A member is a set of n elements, given as difference to a set of the group. The common set is first moved
    to the majority: an element in more than half of the differences is turned over in all of them. With
    d elements left in a difference let ``s = (100 + PERCENT) d - (100 - PERCENT) n``. Members x and y are linked
    if and only if their differences share at least ``(s_x + s_y) / (2 (100 + PERCENT))`` elements. So, exactly:

    * where ``s_x + s_y <= 0`` they are linked, and both are with the member of the smallest s, the centre; its
      pairs make one component of all of these;
    * else they share elements. A member that shares fewer elements with anybody than it would have to share
      with the most central member of another component is linked to nobody and goes: so do the
      rows of one template that have only the template in common;
    * of what is left, members outside the centre's component are compared with all, in blocks of bounded size
      by one matrix product each. A block gives a spanning forest of its links, never more pairs than members.
    """
    sizes = groups.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    count = lambda rows: rows.select("g", F.explode("diff").alias("e")).groupBy("g", "e").agg(F.count(F.lit(1)).alias("f"))
    often = count(groups).filter("f > 1").join(sizes, "g").filter("2 * f > size")
    most = sizes.join(often.groupBy("g").agg(F.collect_list("e").alias("common")), "g", "left")
    most = written(most.withColumn("common", F.coalesce("common", F.array().cast("array<long>"))), "majority")
    moved = F.array_union(F.array_except("diff", "common"), F.array_except("common", "diff"))
    centred = join_lookup(groups, most, ["g"], counts=most, weight="size").withColumn("diff", moved)
    d = F.size("diff").cast("long")
    centred = written(centred.select(*GROUP, d.alias("d"), (FAR * d - NEAR * F.col("n")).alias("s")), "centred")

    centre = centred.groupBy("g").agg(F.min(F.struct("s", "b", "c")).alias("p"), F.count(F.lit(1)).alias("size"))
    centre = centre.select("g", "size", F.col("p.s").alias("ps"), F.col("p.b").alias("pb"), F.col("p.c").alias("pc"))
    narrow = centred.select("g", "b", "c", "s")
    outside = join_lookup(narrow, written(centre, "centres"), ["g"], counts=sizes, weight="size").filter("c <> pc")
    nearest = outside.groupBy("g").agg(F.min("s").alias("qs"))
    centre = written(centre.join(nearest, "g"), "centres")  # one component alone has nothing to look for
    placed = join_lookup(centred, centre, ["g"], counts=centre, weight="size")
    close = placed.filter("s + ps <= 0 AND c <> pc").select(F.least("pb", "b").alias("a"), F.greatest("pb", "b").alias("b"))

    shared = written(count(centred).filter("f > 1"), "shared")
    other = F.when(F.col("c") == F.col("pc"), F.col("qs")).otherwise(F.col("ps"))
    least = F.greatest(F.lit(1), F.ceil((F.col("s") + other) / (2 * FAR))).cast("int")
    elements = placed.select("g", "b", F.explode("diff").alias("e"))
    known = join_lookup(elements, shared, ["g", "e"], counts=shared, weight="f").groupBy("g", "b").agg(
        F.collect_list("e").alias("shared")
    )
    rest = placed.withColumn("least", least).drop("diff").join(known, ["g", "b"]).filter(F.size("shared") >= F.col("least"))
    rest = written(rest.select("g", "b", "c", "n", "d", "shared", (F.col("c") != F.col("pc")).alias("out")), "rest")
    return [written(close, "across"), written(_block_links(rest), "across")]


def _block_links(rest: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of members that are ``out`` with members of other components, by blocks of their groups."""
    pieces = lambda rows: F.greatest(
        F.ceil(F.count_if(rows) / TOGETHER), F.ceil(F.sum(F.when(rows, F.size("shared"))) / ELEMENTS_TOGETHER), F.lit(1)
    ).cast("int")
    grid = rest.groupBy("g").agg(
        F.count(F.lit(1)).alias("size"), pieces(F.col("out")).alias("nx"), pieces(F.lit(True)).alias("ny"),
        F.count_if("out").alias("n_out"),
    ).filter("n_out > 0")
    dealt = join_lookup(rest, written(grid.select("g", "size", "nx", "ny"), "grid"), ["g"], counts=grid, weight="size")
    part = lambda n: F.pmod(F.xxhash64("b"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["g", "b", "c", "n", "d", "shared"]
    x = dealt.filter("out").select(*columns, F.lit(True).alias("x"), part("nx").alias("i"), every("ny").alias("j"))
    y = dealt.select(*columns, F.lit(False).alias("x"), every("nx").alias("i"), part("ny").alias("j"))

    def links(block: pa.Table) -> pa.Table:
        return pa.table(dict(zip("ab", spanning_links(block))))

    return x.union(y).groupBy("g", "i", "j").applyInArrow(links, "a long, b long").filter("a < b").distinct()


def spanning_links(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members, smaller id first, that connect all linked members of a block that are in different
    components: sides ``x`` and not ``x``, with sizes ``n``, differences of ``d`` elements, ``shared`` of them listed."""
    block = block.combine_chunks()
    is_x = block.column("x").to_numpy()
    lists = block.column("shared").combine_chunks()
    lengths = pc.list_value_length(lists).to_numpy()
    rows, values = np.repeat(np.arange(len(is_x)), lengths), lists.flatten().to_numpy()
    kinds, column = np.unique(values, return_inverse=True)
    on_both = np.ones(len(kinds), bool)
    for side in (True, False):
        on_both &= np.bincount(column[is_x[rows] == side], minlength=len(kinds)) > 0
    place = np.cumsum(on_both) - 1
    sides = [np.flatnonzero(is_x), np.flatnonzero(~is_x)]
    within = np.zeros(len(is_x), np.int64)
    for side in sides:
        within[side] = np.arange(len(side))
    both = np.zeros([len(s) for s in sides], np.float32)
    for first in range(0, int(on_both.sum()), COLUMNS_TOGETHER):
        some = on_both[column] & (place[column] >= first) & (place[column] < first + COLUMNS_TOGETHER)
        parts = []
        for k, side in enumerate(sides):
            cells = some & (is_x[rows] == (k == 0))
            part = np.zeros((len(side), COLUMNS_TOGETHER), np.float32)
            part[within[rows[cells]], place[column[cells]] - first] = 1
            parts.append(part)
        both += parts[0] @ parts[1].T
    b, c, n, d = (block.column(k).to_numpy() for k in ("b", "c", "n", "d"))
    p, q = sides
    apart = d[p][:, None] + d[q][None, :] - 2 * both.astype(np.int64)
    linked = (FAR * apart <= NEAR * (n[p][:, None] + n[q][None, :])) & (c[p][:, None] != c[q][None, :])
    left, right = np.nonzero(linked)
    left, right = p[left], q[right]
    _, codes = np.unique(c, return_inverse=True)  # one link for two components is enough
    _, first = np.unique(codes[left] * (codes.max(initial=0) + 1) + codes[right], return_index=True)
    top = list(range(int(codes.max(initial=0)) + 1))

    def find(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    kept = []
    for k in first.tolist():
        x, y = find(codes[left[k]]), find(codes[right[k]])
        if x != y:
            top[x] = y
            kept.append(k)
    left, right = b[left[kept]], b[right[kept]]
    return np.minimum(left, right), np.maximum(left, right)


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """``(node, component)``: the smallest node that each linked node can reach.

    Alternates large and small stars until nothing changes: neighbours are hung under the smallest
    one, which keeps every component connected and lets paths shrink to stars in few rounds. A round
    uses minima and joins only, so a node may have any number of neighbours.
    """
    def hang(pairs, keep_smaller):
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("low"))
        near = pairs.join(low, "u")
        if keep_smaller:
            near = near.filter(F.col("v") != F.col("low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
            near = near.union(low.select("u", F.col("low").alias("v")))
        else:
            near = near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        return near.filter(F.col("u") != F.col("v")).distinct()

    def both_ways(pairs):
        return pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(pairs):
        return pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    pairs = written(pairs.filter(F.col("u") != F.col("v")).distinct(), name)
    before = state(pairs)
    while before[0]:
        large = hang(both_ways(pairs), keep_smaller=False)
        small = hang(large, keep_smaller=True)
        pairs = written(small, name)
        after = state(pairs)
        if after == before:
            break
        before = after
    tops = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)


def classes(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: ``(doc_id, n_shingles, component_id, kept)``, by shingles of ``size`` words."""
    sketched = written(sketches(docs, size), "sketches")
    narrow = sketched.select("doc_id", "n_shingles", "d1", "d2").filter(
        F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    )
    digest = ["n_shingles", "d1", "d2"]
    first = narrow.groupBy(*digest).agg(F.min("doc_id").alias("first"))
    equal = written(narrow.join(first, digest).select("doc_id", "first").distinct(), "equal-sets")
    firsts = equal.select("first").distinct().withColumnRenamed("first", "doc_id")
    members = written(
        sketched.filter(F.col("n_shingles") > 0).join(firsts, "doc_id", "left_semi")
        .select("doc_id", "n_shingles", "registers", "bands"),
        "members",
    )

    keyed = members.select("doc_id", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    ).filter("low < high").select("key", "low")
    crowded = keyed.join(shared, "key").filter("doc_id > low")
    stars = written(crowded.select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct(), "stars")
    links = written(confirmed(written(_estimated(stars, members), "pairs"), docs, size), "confirmed")
    # A document with several rows has several sets; they are one node.
    same = equal.filter("first < doc_id").select(F.col("first").alias("a"), F.col("doc_id").alias("b"))

    found = written(components(links), "components")
    across = _pairs_across(stars, found, docs, size).join(stars, ["a", "b"], "left_anti")
    more = confirmed(written(_estimated(across, members), "pairs"), docs, size)
    final = written(components(links.union(more).union(same)), "components")

    kept = F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    rows = sketched.select("doc_id", "n_shingles").join(final, F.col("doc_id") == F.col("node"), "left")
    return rows.select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    ).withColumn("kept", kept)


def keep_one(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each component, with its own columns; of equal ids the first row by text.

    A null text comes last; rows of equal id and text are told apart by their other columns. Rows with a null id
    all stay.
    """
    found = written(
        classes(docs, size).filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("kept").alias("kept")).filter("n > 1 OR NOT kept"), "not-all-kept"
    )
    # whole rows travel in one column, so no name of theirs meets a name used here
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), F.col("doc_id").cast("long").alias("id"))
    dropped = small_enough(found.select(F.col("doc_id").alias("id")), BROADCAST_IDS)
    once = rows.join(dropped, "id", "left_anti").select("row.*")
    repeated = found.filter("kept").select(F.col("doc_id").alias("id"))
    if repeated.isEmpty():
        return once
    others = [F.col(f"row.`{c}`") for c, kind in docs.dtypes if c != "text" and "map<" not in kind and kind != "variant"]
    first = F.min_by("row", F.struct(F.col("row.text").isNull(), F.col("row.text"), *others))
    same_id = rows.join(small_enough(repeated, BROADCAST_IDS), "id", "left_semi")
    return once.union(same_id.groupBy("id").agg(first.alias("row")).select("row.*"))
