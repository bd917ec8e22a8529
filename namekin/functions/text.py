"""Name-cleaning steps as column expressions. All run in the JVM; none is a UDF."""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

_WHITESPACE = " \t\n\x0b\f\r"
_KEPT = string.ascii_letters + string.digits + " "


def before_slash(name: Column) -> Column:
    """Text before the first ``/``: drops trailing addresses."""
    return F.substring_index(name, "/", 1)


def strip_symbols(name: Column) -> Column:
    """Keep ASCII letters, digits and spaces only.

    What a value holds besides these is told first and then removed: replacing by a regular expression takes
    several times as long, and was most of the time of cleaning.
    """
    return F.call_function("translate", name, F.translate(name, _KEPT, ""), F.lit(""))


def blank_to_empty(name: Column) -> Column:
    """All-whitespace values become the empty string."""
    return F.regexp_replace(name, r"^\s+$", "")


def squeeze_spaces(name: Column, runs: Sequence[int] = (2, 3, 4)) -> Column:
    """One left-to-right pass per run length, each turning such a run into one space.

    A pass does not rescan its own output, so long runs are shortened, not removed;
    ``tokens`` removes what is left.
    """
    for run in runs:
        name = F.replace(name, F.lit(" " * run), F.lit(" "))
    return name


def lookup(value: Column, table: Mapping[str, str]) -> Column:
    """Replace a whole value found in ``table``; one step, not transitive.

    ``value`` is bound to a lambda variable, so a long expression is worked out once although it is
    needed both as the key and as the default.
    """
    if not table:
        return value
    return F.get(F.transform(F.array(value), lambda v: _replaced(v, table)), 0)


def _replaced(value: Column, table: Mapping[str, str]) -> Column:
    """The entry of ``value``, else itself. Maps are searched from end to end, so the few values with an entry are
    told by a hash set first (``isin``, once Catalyst has optimised it)."""
    entries = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.when(value.isin(list(table)), F.coalesce(entries[value], value)).otherwise(value)


def tokens(name: Column) -> Column:
    """Lower-cased whitespace tokens; hyphens separate tokens too."""
    spaced = F.translate(F.lower(name), "-" + _WHITESPACE, " " * (1 + len(_WHITESPACE)))
    return F.filter(F.split(spaced, " "), lambda t: t != "")


def drop_tokens(words: Column, stop: Sequence[str]) -> Column:
    """Remove tokens in the stop list (a hash set once Catalyst has optimised ``isin``)."""
    return F.filter(words, lambda t: ~t.isin(list(stop))) if stop else words


def expand_tokens(words: Column, table: Mapping[str, str]) -> Column:
    """Replace each token found in ``table``."""
    if not table:
        return words
    return F.transform(words, lambda t: _replaced(t, table))


def join_tokens(words: Column) -> Column:
    return F.array_join(words, " ")


def prefix_key(word: Column, length: int = 3) -> Column:
    """First ``length`` characters; a shorter word is its own key."""
    return F.substring(word, 1, length)


def null_safe_length(value: Column) -> Column:
    """String length, 0 for null."""
    return F.coalesce(F.length(value), F.lit(0))
