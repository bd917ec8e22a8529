"""Licence scan with a positional index of rare words.

Every licence template and key phrase is indexed under its rarest words, by position. A text that holds
one of these words gives, per occurrence, the place where the template would begin; the words of the
template are then compared at their relative positions. How rare a word is comes from all texts.
The template index is a constant of a few kilobytes, so texts are scanned in one projection.

Defined cases: a null or blank text has no words, no labels and score 0; rows are judged one by one, so
repeated ids, repeated rows and null ids change nothing; overlapping places all count; an empty table
gives an empty result (every word is then equally rare); further columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from namekin.llm.words import plain_words


@dataclass(frozen=True)
class Template:
    """A licence text. ``phrases`` must stand where the template has them."""

    label: str
    text: str
    phrases: tuple[str, ...]
    share: float = 0.7


#: Phrases that name a licence by themselves.
KEY_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = (
    Template("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("lgpl", "licensed under the gnu lesser general public license version", ("gnu lesser general public license",)),
    Template("agpl-3", "licensed under the gnu affero general public license version 3", ("gnu affero general public license",)),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    Template("apache-2", "licensed under the apache license version 2 0 the license", ("apache license version 2 0",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that", ("redistribution and use in source and binary forms",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4",)),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    Template("cc0", "the person who associated a work with this deed has dedicated the work to the public domain", ("dedicated the work to the public domain",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)
#: Index words per template.
RARE_WORDS = 3


def _vocabulary() -> list[str]:
    texts = [*KEY_PHRASES, *[t.text for t in TEMPLATES]]
    return sorted({w for t in texts for w in t.split()})


def word_rarity(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """Inverse document frequency of every template word over all texts.

    The result has one number per template word, whatever the size of ``docs``.
    """
    words = F.array(*[F.lit(w) for w in _vocabulary()])
    held = docs.select(F.array_intersect(plain_words(F.col(text)), words).alias("held"))
    counted = held.select(F.explode(F.concat("held", F.array(F.lit("")))).alias("word"))
    found = dict(map(tuple, counted.groupBy("word").count().collect()))
    n = found.pop("", 0)
    return {w: math.log((1 + n) / (1 + found.get(w, 0))) + 1 for w in _vocabulary()}


def _index(rarity: dict[str, float]) -> list[tuple[str, int, int]]:
    """``(word, entry, position)`` of the index words; key phrases come first, with one word each."""
    out = []
    for entry, text in enumerate([*KEY_PHRASES, *[t.text for t in TEMPLATES]]):
        words = text.split()
        once = [w for w in dict.fromkeys(words) if words.count(w) == 1]
        best = sorted(once, key=lambda w: (-rarity[w], w))
        for w in best[: 1 if entry < len(KEY_PHRASES) else RARE_WORDS]:
            out.append((w, entry, words.index(w)))
    return out


def _literal(rows: list[tuple], schema: str) -> Column:
    names = [field.split()[0] for field in schema.split(", ")]
    structs = [
        F.struct(*[
            (F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v)).alias(n)
            for n, v in zip(names, row)
        ])
        for row in rows
    ]
    return F.array(*structs).cast(f"array<struct<{schema.replace(' ', ':').replace(',:', ',')}>>")


def scan(
    docs: DataFrame, keep: list[str], text: str = "text", rarity: dict[str, float] | None = None
) -> DataFrame:
    """``keep``, ``n_words``, ``n_base`` (places of key phrases), ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` (comma-joined) and ``score``.

    The score is 1 with a key phrase, otherwise the largest share of a template's rarity that was
    found in place, 0 without any.
    """
    if rarity is None:
        rarity = word_rarity(docs, text)
    n_base = len(KEY_PHRASES)
    index = _index(rarity)
    postings = _literal(index, "word string, entry int, at int")
    bodies = [p.split() for p in [*KEY_PHRASES, *[t.text for t in TEMPLATES]]]
    entries = _literal(
        [(words, [rarity[w] for w in words], sum(rarity[w] for w in words)) for words in bodies],
        "words array<string>, weight array<double>, total double",
    )
    rare = sorted({w for w, _, _ in index})
    words = plain_words(F.col(text))
    rows = docs.select(*keep, words.alias("_words"))
    placed = F.filter(
        F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
        lambda x: x["w"].isin(rare),
    )
    starts = F.flatten(F.transform(placed, lambda p: F.transform(
        F.filter(postings, lambda t: t["word"] == p["w"]),
        lambda t: F.struct(t["entry"].alias("entry"), (p["i"] - t["at"]).alias("at")),
    )))
    some = F.arrays_overlap("_words", F.array(*[F.lit(w) for w in rare]))
    none = F.array().cast("array<struct<entry:int,at:int>>")
    rows = rows.withColumn("_starts", F.when(some, F.array_distinct(starts)).otherwise(none))

    def in_place(s):
        entry = F.get(entries, s["entry"])
        held = F.aggregate(
            F.transform(entry["words"], lambda w, i: F.when(
                F.get("_words", s["at"] + i) == w, F.get(entry["weight"], i)
            ).otherwise(0.0)),
            F.lit(0.0), lambda total, x: total + F.coalesce(x, F.lit(0.0)),
        )
        return F.struct(s["entry"].alias("entry"), s["at"].alias("at"), (held / entry["total"]).alias("share"))

    rows = rows.withColumn("_found", F.transform("_starts", in_place)).drop("_starts")

    def holds(entry, phrase, s):
        whole, part = bodies[entry], phrase.split()
        at = next(i for i in range(len(whole)) if whole[i : i + len(part)] == part)
        same = [F.get("_words", s["at"] + at + k) == w for k, w in enumerate(part)]
        return F.coalesce(F.forall(F.array(*same), lambda x: x), F.lit(False))

    def stands(k, t):
        def good(s):
            out = (s["entry"] == n_base + k) & (s["share"] >= t.share)
            for phrase in t.phrases:
                out = out & holds(n_base + k, phrase, s)
            return out

        return F.when(F.size("_found") > 0, F.exists("_found", good)).otherwise(False)

    def named(entry):
        return F.exists("_exact", lambda s: s["entry"] == entry)

    exact = F.filter("_found", lambda s: (s["entry"] < n_base) & (s["share"] >= 1 - 1e-9))
    rows = rows.withColumns({"_exact": exact} | {f"_t{k}": stands(k, t) for k, t in enumerate(TEMPLATES)})
    base = [
        F.when(named(e), F.lit(name))
        for e, name in enumerate(KEY_PHRASES.values())
    ]
    more = [F.when(F.col(f"_t{k}"), F.lit(t.label)) for k, t in enumerate(TEMPLATES)]
    joined = lambda labels: F.array_join(
        F.sort_array(F.array_distinct(F.array_compact(F.array(*labels)))), ","
    )
    templates = F.transform(F.filter("_found", lambda s: s["entry"] >= n_base), lambda s: s["share"])
    return rows.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.size("_exact").cast("long").alias("n_base"),
        F.array_min(F.transform("_exact", lambda s: s["at"])).cast("long").alias("first_word"),
        F.array_max(F.transform("_exact", lambda s: s["at"])).cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(base + more).alias("labels"),
        F.when(F.size("_exact") > 0, 1.0)
        .otherwise(F.least(F.lit(1.0), F.coalesce(F.array_max(templates), F.lit(0.0)))).alias("score"),
    )
