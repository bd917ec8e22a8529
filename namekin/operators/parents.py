"""Parent matching: each name takes the parent of a similar, more frequent neighbour in name order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from namekin.functions.similarity import SIGNATURE_WORDS, Similarity, letter_signature
from namekin.operators.positions import at_home, frame, in_buckets, with_positions
from namekin.sources.scratch import written

_GROUPS = ["market", "blank"]


def sorted_names(names: DataFrame) -> DataFrame:
    """``(name, market, freq)`` with positions per market.

    Blank names get a group of their own, so they never have neighbours. Names from ``name_frequency(ranged=True)``
    have it already.
    """
    grouped = names if "blank" in names.columns else names.withColumn("blank", F.col("name") == "")
    return with_positions(grouped, _GROUPS, ["name"])


def best_neighbours(
    positioned: DataFrame,
    rng: int = 20,
    threshold: float = 0.90,
    similarity: Similarity = Similarity(),
    edge: str = "skip",
    bucket_size: int = 1024,
) -> DataFrame:
    """The neighbour each name points to: ``(market, blank, pos, name, freq, target_pos,
    target_name, target_freq)``, for names that have one.

    A neighbour counts if it is strictly more frequent, the first in its frame with its frequency,
    has fewer than ``rng`` more frequent neighbours and is similar enough; the most frequent wins.
    All but the similarity is settled before scoring. ``edge="skip"`` leaves the first ``rng`` and
    the last ``rng + 1`` names of a market alone, ``"partial"`` matches them with what is there.
    """
    if edge not in ("skip", "partial"):
        raise ValueError(f"unknown edge mode {edge!r}")
    # Names are dealt out once, to their buckets. Frames hold positions, counts, lengths and letter signatures, and the
    # names that are more frequent than some name near them: no others are pointed to.
    letters = [f"_s{k}" for k in range(SIGNATURE_WORDS)]
    near = frame(_GROUPS, rng)
    spread = in_buckets(positioned.select(*_GROUPS, "pos", "n", "freq", "name"), rng, bucket_size).repartition(*_GROUPS, "_bucket")
    described = spread.withColumns({
        "_length": F.length("name"), **dict(zip(letters, letter_signature("name"))),
        "_target": F.when(F.col("freq") > F.min("freq").over(near), F.col("name")),
    })
    frames = described.withColumn(
        "neighbours", F.collect_list(F.struct("pos", "freq", "_length", *letters, "_target")).over(near)
    ).filter(at_home(bucket_size))
    if edge == "skip":
        frames = frames.filter(F.col("pos").between(rng, F.col("n") - rng - 2))

    above = F.filter("neighbours", lambda x: x["freq"] > F.col("freq"))
    ranked = F.slice(F.sort_array(F.transform(
        above, lambda x: F.struct((-x["freq"]).alias("order"), x["pos"], x["_length"], *[x[c] for c in letters], x["_target"])
    )), 1, rng)

    def usable(ranked):
        def keep(x, i):
            before = F.get(ranked, i - 1)["order"]
            first_of_freq = before.isNull() | (before != x["order"])
            lengths = F.col("_length"), x["_length"]
            alike = similarity.letters_fit(lengths, ([F.col(c) for c in letters], [x[c] for c in letters]), threshold)
            return first_of_freq & similarity.lengths_fit_each(*lengths, threshold) & alike

        return F.transform(F.filter(ranked, keep), lambda x: F.struct(x["order"], x["pos"], x["_target"]))

    # Built as one array value and unpacked by a generator: Catalyst can neither repeat parts of the
    # expression in filters below nor evaluate it twice.
    usable = F.filter(F.transform(F.array(ranked), usable), lambda u: F.size(u) > 0)
    own = [*_GROUPS, "pos", "freq", "name"]
    frames = frames.select(*own, F.explode(usable).alias("usable"))
    pairs = frames.select(*own, F.explode("usable").alias("other")).select(
        *own, F.col("other.order").alias("order"), F.col("other.pos").alias("target_pos"),
        F.col("other._target").alias("target_name"),
    )
    similar = pairs.filter(similarity.reaching(threshold)("name", "target_name"))
    best = F.min(F.struct("order", "target_pos", "target_name", "name", "freq")).alias("best")
    return similar.groupBy(*_GROUPS, "pos").agg(best).select(
        *_GROUPS, "pos", "best.name", "best.freq", "best.target_pos", "best.target_name",
        (-F.col("best.order")).alias("target_freq"),
    )


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Join on the columns, null equal to null; the columns of ``left`` stay."""
    renamed = right.withColumnsRenamed({c: f"_of_{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & left[c].eqNullSafe(renamed[f"_of_{c}"])
    return left.join(renamed, same, how).drop(*[f"_of_{c}" for c in columns])


def follow_pointers(pointers: DataFrame, groups: Sequence[str] = _GROUPS) -> DataFrame:
    """Final target of every pointer: ``(groups, pos, target_pos, target_name)``.

    A pointer to an earlier row takes over what that row points to; a pointer to a later row, or to one that
    points nowhere, ends there. A round lets open rows jump to the target of their target, and then closes
    those whose target was closed in the round before. An open row can only point to a row that is open or
    was closed in the last round, so a round reads these two and no others, and both shrink: the closed
    part of a chain doubles each round. Frequency rises along a chain, so there are no cycles.
    """
    keys = [*groups, "pos"]
    columns = [*keys, "target_pos", "target_name", "open"]

    def targets(rows: DataFrame) -> DataFrame:
        return rows.select(
            *groups, F.col("pos").alias("target_pos"), F.col("target_pos").alias("next_pos"),
            F.col("target_name").alias("next_name"), F.col("open").alias("next_open"),
        )

    def taken_over(rows: DataFrame, ahead: DataFrame, opened, over) -> DataFrame:
        """``over`` tells from what was found at the target whether it is taken over, ``opened`` whether it stays open."""
        found = _same(rows, targets(ahead), [*groups, "target_pos"], "left")
        pick = lambda new, old: F.when(over, F.col(new)).otherwise(F.col(old)).alias(old)
        return found.select(*keys, pick("next_pos", "target_pos"), pick("next_name", "target_name"), opened.alias("open"))

    start = pointers.withColumn("open", F.col("target_pos") < F.col("pos")).select(*columns)
    latest = written(start, "pointers")
    closed = [latest.filter(~F.col("open"))]
    still = F.coalesce("next_open", F.lit(False))
    latest = written(taken_over(latest.filter("open"), latest, still, ~F.coalesce("next_open", F.lit(True))), "pointers")
    while not (opened := latest.filter("open")).isEmpty():
        fresh = latest.filter(~F.col("open"))
        closed.append(fresh)
        found = F.col("next_pos").isNotNull()
        jumped = taken_over(opened, opened, F.lit(True), found)
        latest = written(taken_over(jumped, fresh, ~found, found), "pointers")
    result = latest
    for part in closed:
        result = result.unionByName(part)
    return result.drop("open")


def assign_parents(
    names: DataFrame,
    rng: int = 20,
    threshold: float = 0.90,
    similarity: Similarity = Similarity(),
    edge: str = "skip",
    bucket_size: int = 1024,
    per_market: bool = True,
) -> DataFrame:
    """Parent of every name: ``(name, market, freq, parent_name)``.

    ``names`` holds ``(name, market, freq)``, one row per name and market, a null market being one of
    its own; with
    ``per_market=False`` it holds ``(name, freq)`` and all names are matched together.
    """
    positioned, found = other_parents(names, rng, threshold, similarity, edge, bucket_size, per_market)
    matched = _same(positioned, found.drop("name"), ["market", "blank", "pos"], "left").select(
        "name", "market", "freq", F.coalesce("parent_name", "name").alias("parent_name")
    )
    return matched if per_market else matched.drop("market")


def other_parents(
    names: DataFrame,
    rng: int = 20,
    threshold: float = 0.90,
    similarity: Similarity = Similarity(),
    edge: str = "skip",
    bucket_size: int = 1024,
    per_market: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """All names with their positions, and ``(market, blank, pos, name, parent_name)`` of those with another parent
    than themselves, which are written: mostly few. The market is blank with ``per_market=False``."""
    if not per_market:
        names = names.withColumn("market", F.lit(""))
    positioned = sorted_names(names.select("name", "market", "freq", *[c for c in names.columns if c == "blank"]))
    pointers = written(best_neighbours(positioned, rng, threshold, similarity, edge, bucket_size), "neighbours")
    final = follow_pointers(pointers).select(*_GROUPS, "pos", F.col("target_name").alias("parent_name"))
    named = _same(final, pointers.select(*_GROUPS, "pos", "name"), [*_GROUPS, "pos"], "inner")
    return positioned, written(named.select(*_GROUPS, "pos", "name", "parent_name"), "parents")
