"""Prefix trie of conversations, with subtree sums by centroid decomposition.

1. Turns are numbered after a range sort of narrow rows (id, turn, digest of role and text, code points), so a
   conversation of any length is spread over many tasks; texts are not shuffled. Rebuilding joins at most
   ``HEAD`` turns of a leading conversation with the conversations that start with it.
2. The node of a turn is the running exclusive-or of two 64-bit hashes of (place, digest): the same for equal
   sequences, and computed block by block. Grouping the turns by node gives members, owner (smallest
   member) and weight (turns of all members from the node on), combined before the shuffle.
3. The forest of parent edges is split at centroids. In a component of total weight W the nodes with more than
   half of W in their subtree are exactly the path from the centroid, the deepest of them, to the top. So one
   filter and one aggregate find all centroids and paths of a round. Whether another node lies below the
   centroid, and under which child, is read from the turns of the node's owner. Totals of the components below
   make the sum of the centroid, which is added along the path; the components below and the one
   above go on alone, each with at most half of the weight.
4. Components of at most ``PIECE`` weight are finished by the same rounds inside the tasks, many at once.

A round halves the weight of every component, so the number of rounds is the logarithm of the number of turns,
for chains as for stars.

Defined cases: null roles and texts are empty; turns of equal number (null is the first number) are ordered
by the digest of role and text, repeated rows are turns of their own; rows without conversation id belong to
no conversation and are left out; an empty table has no nodes; only ``conv_id``, ``turn``, ``role`` and ``text`` are
read.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from namekin.llm.words import whole
from namekin.operators.positions import with_positions
from namekin.operators.skew import join_lookup
from namekin.sources.scratch import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A conversation may begin with up to this many turns of the leading one of its ``GROUP``.
HEAD, GROUP = 5, 100
#: Turns whose hashes are run up in one window.
BLOCK = 1 << 16
#: Weight up to which a component is finished inside one task.
PIECE = 1 << 14
#: Rows of one component, or of one conversation, that meet in one task of a join.
TOGETHER = 1 << 20
#: Ids joined to one piece of text before the pieces of a node meet.
IDS_TOGETHER = 1 << 13

NODE = "struct<a:bigint,b:bigint>"


def root() -> Column:
    """The node of no turns."""
    return F.struct(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))


# Turns

def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, n, digest, points)``: the turns of every conversation in order, ``pos`` from 0."""
    role, text = whole("role"), whole("text")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.length(text).cast("long").alias("points"),
    )
    return with_positions(rows, ["conv_id"], ["turn", "digest"]).select("conv_id", "pos", "n", "digest", "points")


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes from its leading one."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, length, digest, points)`` of the rebuilt turns, and ``(conv_id, length)`` of all
    conversations. ``turns`` should be a written table."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    lead = F.col("conv_id") - F.col("conv_id") % GROUP
    leaders = sizes.filter(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("lead"), F.col("n").alias("n_lead"))
    about = sizes.withColumns({"lead": lead, "h": head_length(F.col("conv_id"))}).join(leaders, "lead", "left")
    about = written(
        about.withColumn("taken", F.least("h", F.coalesce("n_lead", F.lit(0))).cast("long"))
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .select("conv_id", "lead", "h", "taken", "length", "n"),
        "conversations",
    )
    heads = turns.filter((F.col("conv_id") % GROUP == 0) & (F.col("pos") < HEAD)).select(
        F.col("conv_id").alias("lead"), "pos", "digest", "points"
    )
    first = about.join(heads, "lead").filter(F.col("pos") < F.col("taken")).select(
        "conv_id", (F.col("pos") + 1).alias("depth"), "length", "digest", "points"
    )
    own = join_lookup(
        turns.filter(F.col("pos") >= head_length(F.col("conv_id"))).select("conv_id", "pos", "digest", "points"),
        about.select("conv_id", "h", "taken", "length"), ["conv_id"], counts=about.select("conv_id", "n"),
    ).select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "length", "digest", "points")
    return first.union(own), about.select("conv_id", "length")


def paths(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(conv_id, depth, length, points, node, parent)`` of rebuilt turns."""
    term = lambda seed: F.xxhash64(F.lit(seed), F.col("depth"), F.col("digest"))
    rows = turns.withColumns({"block": F.floor((F.col("depth") - 1) / block), "a": term(1), "b": term(2)})
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = written(
        rows.select("conv_id", "block", "depth", "length", "points", "a", "b", F.bit_xor("a").over(run).alias("x"), F.bit_xor("b").over(run).alias("y")),
        "runs",
    )
    ends = rows.filter((F.col("depth") % block == 0) & (F.col("depth") < F.col("length")))
    up = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    before = ends.select(
        "conv_id", (F.col("block") + 1).alias("block"),
        F.bit_xor("x").over(up).alias("x0"), F.bit_xor("y").over(up).alias("y0"),
    )
    x = F.col("x").bitwiseXOR(F.coalesce("x0", F.lit(0)))
    y = F.col("y").bitwiseXOR(F.coalesce("y0", F.lit(0)))
    return rows.join(before, ["conv_id", "block"], "left").select(
        "conv_id", "depth", "length", "points", F.struct(x.alias("a"), y.alias("b")).alias("node"),
        F.struct(x.bitwiseXOR(F.col("a")).alias("a"), y.bitwiseXOR(F.col("b")).alias("b")).alias("parent"),
    )


# Nodes

def nodes(steps: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: ``(node, parent, depth, points, owner, chain, n_convs, weight, n_children, parent_owner)``.

    ``owner`` is the smallest member and ``chain`` its number of turns. Both inputs should be written tables.
    """
    grouped = steps.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.first("points").alias("points"),
        F.min(F.struct("conv_id", "length")).alias("own"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    top = lengths.agg(
        F.min(F.struct("conv_id", "length")).alias("own"), F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") + 1).alias("weight"),
    ).filter("n_convs > 0").select(
        root().alias("node"), F.lit(None).cast(NODE).alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("points"), "own", "n_convs", "weight",
    )
    every = written(grouped.union(top), "nodes")
    children = written(
        every.filter(F.col("parent").isNotNull()).groupBy("parent").agg(F.count(F.lit(1)).alias("n_children")), "children"
    )
    owners = every.select(F.col("node").alias("parent"), F.col("own.conv_id").alias("parent_owner"))
    found = join_lookup(every, owners, ["parent"], "left", counts=children, weight="n_children")
    counts = children.withColumnRenamed("parent", "node")
    return found.join(counts, "node", "left").na.fill(0, ["n_children"]).select(
        "node", "parent", "depth", "points", F.col("own.conv_id").alias("owner"), F.col("own.length").alias("chain"),
        "n_convs", "weight", "n_children", "parent_owner",
    )


def ends_digests(steps: DataFrame, lengths: DataFrame, ids_together: int = IDS_TOGETHER) -> DataFrame:
    """``(node, ends_sha256)`` of the nodes where conversations end: digest of their ids, ascending.

    A global sort deals the ids of a node over tasks, which join them to pieces; only the pieces of a node
    meet, and pass through the hash one after the other.
    """
    ends = steps.filter("depth = length").select("node", "conv_id").union(
        lengths.filter("length = 0").select(root().alias("node"), "conv_id")
    ).select("node.a", "node.b", "conv_id")

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, ids = (batch.column(k).to_numpy() for k in range(3))
            new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, int)
            new = np.unique(np.concatenate([new, np.arange(0, len(a), ids_together)]))
            pieces = [",".join(map(str, p.tolist())) for p in np.split(ids, new[1:])] if len(new) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(a[new]), pa.array(b[new]), pa.array(ids[new]), pa.array(pieces, pa.string())],
                names=["a", "b", "conv_id", "ids"],
            )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, state = None, None
        for batch in batches:
            done = []
            for a, b, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (a, b) == open_node:
                    state.update(b"," + ids.encode())
                else:
                    if open_node:
                        done.append((*open_node, state.hexdigest()))
                    open_node, state = (a, b), hashlib.sha256(ids.encode())
            yield as_batch(done)
        yield as_batch([(*open_node, state.hexdigest())] if open_node else [])

    def as_batch(rows):
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["a", "b", "sha"])

    pieces = written(
        ends.orderBy("a", "b", "conv_id").mapInArrow(join_ids, "a long, b long, conv_id long, ids string"), "ends"
    )
    dealt = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "conv_id")
    found = dealt.mapInArrow(digest, "a long, b long, sha string")
    return found.select(F.struct("a", "b").alias("node"), F.col("sha").alias("ends_sha256"))


# Rollup

STATE = [
    "node", "parent", "depth", "owner", "chain", "n_convs", "weight", "leaves", "saved", "more_leaves", "more_saved", "top", "total",
]


def rollup(found: DataFrame, steps: DataFrame, piece: int = PIECE, together: int = TOGETHER) -> DataFrame:
    """``(node, n_leaves, saved_tokens)``: sums over the subtree of every node, by centroid decomposition.

    ``found`` is the table of ``nodes`` and ``steps`` that of ``paths``, both written.
    """
    zero = F.lit(0).cast("long")
    whole_tree = found.filter(F.col("parent").isNull()).agg(F.max("weight")).first()[0] or 0
    state = found.select(
        "node", "parent", "depth", "owner", "chain", "n_convs", "weight",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("points")).alias("saved"),
        zero.alias("more_leaves"), zero.alias("more_saved"), root().alias("top"), F.lit(whole_tree).cast("long").alias("total"),
    )
    done, closed = [], [state.filter(F.col("total") <= piece)]
    state = state.filter(F.col("total") > piece)
    going = whole_tree > piece
    while going:
        split = written(_split(state, steps, together), "split")
        settled, state = _add_up(split, together)
        done.append(written(settled, "centroids"))
        state = written(state, "components")
        closed.append(state.filter(F.col("total") <= piece))
        state = state.filter(F.col("total") > piece)
        going = not state.isEmpty()
    out = _finished(_union(closed))
    return _union([*done, out])


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _parts(rows: Column, together: int) -> Column:
    return F.ceil(rows / together).cast("int")


def _meet(big: DataFrame, small: DataFrame, keys: list[str], rows: str, spread: str, together: int) -> DataFrame:
    """Inner join to a table with one row per key; keys with more than ``together`` rows are split.

    ``rows``, a column of both, bounds the rows of a key in ``big``; ``spread`` differs among them.
    """
    parts = _parts(F.greatest(F.col(rows), F.lit(1)), together)
    left = big.withColumn("part", F.pmod(F.xxhash64(spread), parts).cast("int"))
    right = small.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(rows)
    return left.join(right, [*keys, "part"]).drop("part")


def _split(state: DataFrame, steps: DataFrame, together: int) -> DataFrame:
    """Every row of ``state`` with its role (centroid, path or rest), its component from now on (``into``)
    and the weight of its centroid."""
    heavy = state.filter(F.col("weight") * 2 > F.col("total"))
    centres = heavy.groupBy("top").agg(
        F.max_by(F.struct("node", "depth", "weight"), "depth").alias("centre"), F.first("total").alias("total")
    )
    met = _meet(state, centres, ["top"], "total", "node", together)
    role = (
        F.when(F.col("node") == F.col("centre.node"), "centroid")
        .when(F.col("weight") * 2 > F.col("total"), "path").otherwise("rest")
    )
    met = met.withColumns({"role": role, "gone": F.col("centre.weight")})
    level = [*STATE, "role", "gone"]
    above = met.filter(F.col("depth") <= F.col("centre.depth")).select(*level, F.col("top").alias("into"))
    # deeper ones: the owner's turn just below the centroid's depth tells on which side they are
    below = met.filter(F.col("depth") > F.col("centre.depth")).select(
        *level, F.col("centre.node").alias("centre"), (F.col("centre.depth") + 1).alias("step")
    )
    turns = steps.select(
        F.col("conv_id").alias("owner"), F.col("depth").alias("step"), F.col("length").alias("chain"),
        F.col("node").alias("child"), F.col("parent").alias("child_of"),
    )
    below = _meet(below, turns, ["owner", "step"], "chain", "node", together)
    into = F.when(F.col("child_of") == F.col("centre"), F.col("child")).otherwise(F.col("top"))
    return above.union(below.select(*level, into.alias("into")))


def _add_up(split: DataFrame, together: int) -> tuple[DataFrame, DataFrame]:
    """The finished centroids, and the state of the components that are left."""
    totals = written(
        split.filter("role <> 'centroid'").groupBy("top", "into", "total").agg(
            F.sum("n_convs").alias("left"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
        ), "totals"
    )
    below = totals.filter(F.col("into") != F.col("top")).groupBy("top").agg(
        F.sum("leaves").alias("below_leaves"), F.sum("saved").alias("below_saved")
    )
    centres = split.filter("role = 'centroid'").join(below, "top", "left").na.fill(0, ["below_leaves", "below_saved"])
    centres = written(
        centres.select(
            "node", "top", (F.col("leaves") + F.col("below_leaves")).alias("add_leaves"),
            (F.col("saved") + F.col("below_saved")).alias("add_saved"), "more_leaves", "more_saved",
        ), "sums",
    )
    settled = centres.select(
        "node", (F.col("add_leaves") + F.col("more_leaves")).alias("n_leaves"),
        (F.col("add_saved") + F.col("more_saved")).alias("saved_tokens"),
    )
    added = centres.select("top", "add_leaves", "add_saved")
    news = totals.join(added, "top").select("into", "total", "left", "add_leaves", "add_saved")
    rest = _meet(split.filter("role <> 'centroid'"), news, ["into"], "total", "node", together)
    on_path = lambda c: F.when(F.col("role") == "path", F.col(c)).otherwise(0)
    changed = {
        "weight": F.col("weight") - on_path("gone"), "more_leaves": F.col("more_leaves") + on_path("add_leaves"),
        "more_saved": F.col("more_saved") + on_path("add_saved"), "top": F.col("into"), "total": F.col("left"),
    }
    return settled, rest.select(*[changed.get(c, F.col(c)).alias(c) for c in STATE])


def _finished(closed: DataFrame) -> DataFrame:
    """Sums of all components of small weight, each whole in one task."""
    columns = {
        "ta": "top.a", "tb": "top.b", "a": "node.a", "b": "node.b", "pa": "parent.a", "pb": "parent.b", "depth": "depth",
        "n_convs": "n_convs", "weight": "weight", "leaves": "leaves", "saved": "saved", "more_leaves": "more_leaves", "more_saved": "more_saved",
    }
    flat = closed.select(*[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(k) for k, c in columns.items()])
    dealt = flat.repartition("ta", "tb").sortWithinPartitions("ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            waiting.append(batch.to_pandas())
            rows += batch.num_rows
            if rows >= 1 << 16:
                table = pd.concat(waiting, ignore_index=True)
                last = (table["ta"] == table["ta"].iloc[-1]) & (table["tb"] == table["tb"].iloc[-1])
                if not last.all():
                    yield solved(table[~last].reset_index(drop=True))
                waiting = [table[last]]
                rows = int(last.sum())
        if rows:
            yield solved(pd.concat(waiting, ignore_index=True))

    def solved(table: pd.DataFrame) -> pa.RecordBatch:
        leaves, saved = component_sums(table)
        return pa.RecordBatch.from_arrays(
            [pa.array(table["a"]), pa.array(table["b"]), pa.array(leaves), pa.array(saved)],
            names=["a", "b", "n_leaves", "saved_tokens"],
        )

    out = dealt.mapInArrow(run, "a long, b long, n_leaves long, saved_tokens long")
    return out.select(F.struct("a", "b").alias("node"), "n_leaves", "saved_tokens")


def component_sums(table: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Subtree sums of whole components, split at their centroids until every node has been one."""
    n = len(table)
    place = table[["a", "b"]].assign(place=np.arange(n))
    at = table[["pa", "pb"]].merge(place, left_on=["pa", "pb"], right_on=["a", "b"], how="left")["place"]
    parent = at.fillna(-1).to_numpy(np.int64)
    parent[(table["depth"] == 0).to_numpy()] = -1
    depth, weight = table["depth"].to_numpy(), table["weight"].to_numpy().copy()
    own = table[["leaves", "saved"]].to_numpy()
    more = table[["more_leaves", "more_saved"]].to_numpy().copy()
    sums = np.zeros((n, 2), np.int64)
    alive = np.arange(n)
    top = np.zeros(n, np.int64)
    _climb(parent, alive, top)
    while len(alive):
        total = weight[top[alive]]
        heavy = alive[weight[alive] * 2 > total]
        order = heavy[np.lexsort((depth[heavy], top[heavy]))]
        deepest = np.append(top[order][1:] != top[order][:-1], True)
        centres = order[deepest]
        path, is_centre = order[~deepest], np.zeros(n, bool)
        is_centre[centres] = True
        centre_of = np.zeros(n, np.int64)
        centre_of[top[centres]] = centres
        of_path = centre_of[top[path]]

        above = parent[alive]
        children = alive[(above >= 0) & is_centre[above]]
        parent_of = parent[children]
        parent[children] = -1
        rest = alive[~is_centre[alive]]
        _climb(parent, rest, top)
        totals = np.zeros((n, 2), np.int64)
        np.add.at(totals, top[rest], own[rest])
        sums[centres] = own[centres]
        np.add.at(sums, parent_of, totals[children])
        more[path] += sums[of_path]
        weight[path] -= weight[of_path]
        sums[centres] += more[centres]
        alive = rest
    return sums[:, 0], sums[:, 1]


def _climb(parent: np.ndarray, some: np.ndarray, top: np.ndarray) -> None:
    """Set ``top`` of some nodes to the highest node that they reach."""
    top[some] = np.where(parent[some] >= 0, parent[some], some)
    for _ in range(max(1, math.ceil(math.log2(len(some) + 1)) + 1)):
        higher = top[top[some]]
        if np.array_equal(higher, top[some]):
            break
        top[some] = higher


def trie(conversations: DataFrame, piece: int = PIECE, together: int = TOGETHER) -> DataFrame:
    """One row per node of the trie: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``; ``conv_id`` is the node's smallest member."""
    turns, lengths = rebuilt(written(ordered_turns(conversations), "turns"))
    steps = written(paths(turns), "paths")
    found = written(nodes(steps, lengths), "trie")
    sums = rollup(found, steps, piece, together)
    ends = ends_digests(steps, lengths)
    none = hashlib.sha256(b"").hexdigest()
    return found.join(sums, "node").join(ends, "node", "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent_owner").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
