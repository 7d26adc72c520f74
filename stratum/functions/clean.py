"""Column cleaning expressions.

Every helper returns one ``DataFrame.withColumns`` call, so a chain of them
collapses into a single ``Project`` and stays inside whole-stage codegen.
No Python runs per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.operators.columns import validate_columns

# The default string forms of "no value" recognised by
# normalize_null_values, compared case-sensitively after trimming spaces.
DEFAULT_NULL_TOKENS = ("", "NULL", "null", "N/A", "NA")


def _apply(df: DataFrame, columns: Iterable[str], fn) -> DataFrame:
    columns = list(columns)
    validate_columns(df, columns)
    if not columns:
        return df
    return df.withColumns({c: fn(F.col(c)) for c in columns})


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip spaces at both ends (tabs and newlines are kept, as F.trim does)."""
    return _apply(df, columns, F.trim)


def uppercase_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """E2."""
    return _apply(df, columns, F.upper)


def lowercase_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """E3."""
    return _apply(df, columns, F.lower)


def empty_to_null(c: Column) -> Column:
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def nullify_empty_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Null when the space-trimmed value is empty; other values unchanged."""
    return _apply(df, columns, empty_to_null)


def null_token_to_null(c: Column, tokens: Sequence[str] = DEFAULT_NULL_TOKENS) -> Column:
    return F.when(F.trim(c).isin(list(tokens)), F.lit(None)).otherwise(c)


def normalize_null_values(
    df: DataFrame, columns: Iterable[str], null_values: Sequence[str] = DEFAULT_NULL_TOKENS
) -> DataFrame:
    """E5: null when the trimmed value is one of ``null_values`` (case-sensitive).

    Values that are not tokens are returned untouched, not trimmed.
    """
    tokens = list(null_values)
    return _apply(df, columns, lambda c: null_token_to_null(c, tokens))


def standardize(
    df: DataFrame,
    trim: Iterable[str] = (),
    null_tokens: Iterable[str] = (),
    upper: Iterable[str] = (),
    tokens: Sequence[str] = DEFAULT_NULL_TOKENS,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Trim, then null tokens, then upper case, as one projection.

    The order matters (D8): ``" na "`` is not a token (case-sensitive), so it
    survives and becomes ``NA``.  ``extra`` adds columns computed from the
    *input* values in the same projection (e.g. a record id taken before
    cleaning).
    """
    trim, null_tokens, upper = set(trim), set(null_tokens), set(upper)
    touched = trim | null_tokens | upper
    validate_columns(df, touched)
    exprs = {}
    for name in [c for c in df.columns if c in touched]:
        e = F.col(name)
        if name in trim:
            e = F.trim(e)
        if name in null_tokens:
            e = null_token_to_null(e, tokens)
        if name in upper:
            e = F.upper(e)
        exprs[name] = e
    exprs.update(extra or {})
    return df.withColumns(exprs) if exprs else df


def record_id_copy(column: str) -> Column:
    """The id exactly as received, taken before any cleaning."""
    return F.col(column)


def record_id_concat_skip_null(columns: Sequence[str], sep: str = "|") -> Column:
    """``a|b``; null parts are left out (``concat_ws`` semantics)."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in columns])


def record_id_concat_keep_empty(columns: Sequence[str], sep: str = "|") -> Column:
    """``a|b|`` — every part cast to string, null parts kept as empty."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
