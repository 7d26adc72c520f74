"""Row predicates used by the key and business-rule filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _conjunction(parts: list[Column]) -> Column:
    if not parts:
        return F.lit(True)
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def not_null(columns: Sequence[str]) -> Column:
    """every column is not null."""
    return _conjunction([F.col(c).isNotNull() for c in columns])


def present(columns: Sequence[str]) -> Column:
    """Every column is not null and not the empty string."""
    return _conjunction([F.col(c).isNotNull() & (F.col(c) != F.lit("")) for c in columns])


def requirement(present_cols: Sequence[str] = (), not_null_cols: Sequence[str] = ()) -> Column:
    """One generated conjunction: ``present`` columns plus ``not_null``-only columns."""
    return present(present_cols) & not_null(not_null_cols)


def all_null(columns: Sequence[str]) -> Column:
    return _conjunction([F.col(c).isNull() for c in columns])
