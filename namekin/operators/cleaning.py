"""Name cleaning and record preparation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from namekin import lists
from namekin.functions import text


def clean_name(
    name: Column,
    *,
    stop_tokens: Sequence[str] = lists.STOP_TOKENS,
    token_expansions: Mapping[str, str] = lists.TOKEN_EXPANSIONS,
    number_aliases: Mapping[str, str] = lists.NUMBER_ALIASES,
    name_aliases: Mapping[str, str] = lists.NAME_ALIASES,
    squeeze_runs: Sequence[int] = (2, 3, 4),
) -> Column:
    """The full cleaning chain as one expression; never null.

    Order matters: number aliases are looked up before lower-casing, stop tokens are dropped before
    abbreviations are expanded, whole-name aliases come last.
    """
    name = text.before_slash(F.coalesce(name, F.lit("")))
    name = text.strip_symbols(name)
    name = text.squeeze_spaces(text.blank_to_empty(name), squeeze_runs)
    name = text.lookup(name, number_aliases)
    words = text.drop_tokens(text.tokens(name), stop_tokens)
    name = text.join_tokens(text.expand_tokens(words, token_expansions))
    # Never null already; saying so keeps Catalyst from repeating the chain in a null filter.
    return F.coalesce(text.lookup(name, name_aliases), F.lit(""))


def clean_names(
    records: DataFrame, raw: str = "raw_name", output: str = "name_clean", **options
) -> DataFrame:
    """Add the cleaned name as column ``output``. A narrow projection: no shuffle, no Python."""
    return records.withColumn(output, clean_name(F.col(raw), **options))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (listed) column."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def blank_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls in string columns by the empty string."""
    return df.na.fill("", subset=list(columns))


def in_trailing_window(
    records: DataFrame,
    as_of: str,
    months: int = 12,
    date: str = "as_of",
    market: str = "market",
    markets: Sequence[str] | None = None,
) -> DataFrame:
    """Records of the listed markets dated at most ``months`` months before ``as_of``.

    The bound is folded to a literal of the column's own type, so it reaches the file scan.
    """
    kind = records.schema[date].dataType
    bound = F.add_months(F.lit(as_of).cast("date"), -months).cast(kind)
    kept = records.filter(F.col(date) >= bound)
    return kept.filter(F.col(market).isin(list(markets))) if markets is not None else kept


_NON_NULL_DEFAULTS = {
    T.StringType: "", T.BooleanType: False,
    T.ByteType: 0, T.ShortType: 0, T.IntegerType: 0, T.LongType: 0,
    T.FloatType: 0.0, T.DoubleType: 0.0,
}


def set_nullability(df: DataFrame, columns: Sequence[str], nullable: bool = True) -> DataFrame:
    """Set the nullable flag of the listed columns without leaving the DataFrame plan.

    ``nullable=False`` is enforced: a null met at run time raises.
    """
    if nullable:
        # A branch without an alternative is nullable to the analyser; the optimiser removes it.
        return df.withColumns({
            f.name: F.when(F.col(f.name).isNotNull(), F.col(f.name))
            for f in df.schema if f.name in columns and not f.nullable
        })

    def checked(field: T.StructField) -> Column:
        default = F.lit(_NON_NULL_DEFAULTS[type(field.dataType)]).cast(field.dataType)
        failure = F.raise_error(F.lit(f"null in non-null column {field.name}")).cast(field.dataType)
        value = F.when(F.col(field.name).isNull(), failure).otherwise(F.col(field.name))
        # The literal is never used; it only tells Catalyst that the result cannot be null.
        return F.coalesce(value, default)

    return df.withColumns({f.name: checked(f) for f in df.schema if f.name in columns})
