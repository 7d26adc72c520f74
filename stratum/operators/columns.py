"""Column presence, alignment, projection and contract conformance.

All checks on names and types happen at plan time on the driver (they read
``df.schema`` only).  NOT NULL is enforced inside the producing plan
(``enforce_not_null``) so publishing needs no second pass; the reporting
forms (``null_violations``, ``cast_failures``) are one aggregate each, with
partial (map-side) aggregation and a one-row result.
"""

from __future__ import annotations

from collections.abc import Sequence, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.contracts import Contract


def validate_columns(df: DataFrame, columns: Iterable[str]) -> None:
    """Raise ``ValueError`` naming every missing column, sorted."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def _convert(c: SparkColumn, dtype: T.DataType, strict: bool) -> SparkColumn:
    return c.cast(dtype) if strict else c.try_cast(dtype)


def align_to_contract(df: DataFrame, contract: Contract | T.StructType, strict: bool = False) -> DataFrame:
    """Order, cast, null-fill missing and drop extra columns, by name.

    ``strict=False`` (default, D20) uses ``try_cast`` so one malformed value
    becomes null instead of failing the whole batch under ANSI mode;
    ``strict=True`` uses ``cast`` and fails on bad values.
    """
    schema = contract.schema() if isinstance(contract, Contract) else contract
    present = set(df.columns)
    exprs = []
    for f in schema.fields:
        if f.name in present:
            src = F.col(f"`{f.name}`")
            e = src if df.schema[f.name].dataType == f.dataType else _convert(src, f.dataType, strict)
        else:
            e = F.lit(None).cast(f.dataType)
        exprs.append(e.alias(f.name, metadata=f.metadata))
    return df.select(*exprs)


def cast_failure_counts(df: DataFrame, contract: Contract | T.StructType) -> list[SparkColumn]:
    """The aggregates of ``cast_failures``; a stream observes them while it writes."""
    schema = contract.schema() if isinstance(contract, Contract) else contract
    aggs = []
    for f in schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            c = F.col(f"`{f.name}`")
            aggs.append(F.count_if(c.isNotNull() & c.try_cast(f.dataType).isNull()).alias(f.name))
    return aggs


def rescued(df: DataFrame, contract: Contract | T.StructType, ignored: Sequence[str] = ()) -> SparkColumn | None:
    """What ``align_to_contract`` would lose of a row, as VARIANT: raw text by column, null if nothing is lost.

    Held are values that fail their cast and the values of columns that the
    contract does not have, but for ``ignored`` ones.  ``None`` if the
    columns already fit.
    """
    schema = contract.schema() if isinstance(contract, Contract) else contract
    kinds = {f.name: f.dataType for f in schema.fields}
    kept = []
    for f in df.schema.fields:
        c, text = F.col(f"`{f.name}`"), F.col(f"`{f.name}`").cast("string")
        if f.name not in kinds and f.name not in ignored:
            kept.append((f.name, c.isNotNull(), text))
        elif f.name in kinds and f.dataType != kinds[f.name]:
            kept.append((f.name, c.isNotNull() & c.try_cast(kinds[f.name]).isNull(), text))
    if not kept:
        return None
    entries = F.array_compact(F.array(*[F.when(lost, F.struct(F.lit(name).alias("key"), text.alias("value"))) for name, lost, text in kept]))
    return F.when(reduce(or_, [lost for _, lost, _ in kept]), F.parse_json(F.to_json(F.map_from_entries(entries))))


def cast_failures(df: DataFrame, contract: Contract | T.StructType) -> DataFrame:
    """Count, per contract column, values that are non-null in ``df`` but fail the cast.

    One global aggregate; the result has one row and one column per checked
    column (columns already of the right type or absent are skipped).
    """
    aggs = cast_failure_counts(df, contract)
    if not aggs:
        return df.sparkSession.range(1).select(F.lit(0).alias("_none"))
    return df.agg(*aggs)


def project(df: DataFrame, contract: Contract, renames: dict[str, str] | None = None,
            computed: dict[str, SparkColumn] | None = None) -> DataFrame:
    """Select the contract's columns in contract order.

    ``renames`` maps contract column -> input column (e.g.
    ``source_ingestion_timestamp`` <- ``ingestion_timestamp``); ``computed``
    maps contract column -> expression (record timestamps).
    """
    renames = renames or {}
    computed = computed or {}
    exprs = []
    needed = []
    for c in contract.columns:
        if c.name in computed:
            exprs.append(computed[c.name].cast(c.dtype).alias(c.name))
        else:
            src = renames.get(c.name, c.name)
            needed.append(src)
            exprs.append(F.col(src).alias(c.name) if src != c.name else F.col(src))
    validate_columns(df, needed)
    return df.select(*exprs)


def schema_diff(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """Plan-time part of C6: (column, problem, detail) for missing/extra/mistyped columns."""
    problems = []
    actual = {f.name: f.dataType for f in df.schema.fields}
    for c in contract.columns:
        if c.name not in actual:
            problems.append((c.name, "missing", c.dtype.simpleString()))
        elif actual[c.name] != c.dtype:
            problems.append((c.name, "type", f"{actual[c.name].simpleString()} != {c.dtype.simpleString()}"))
    for name in actual:
        if name not in contract.names:
            problems.append((name, "extra", actual[name].simpleString()))
    return problems


def null_violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Data part of C6: nulls per NOT NULL column, as (column, null_count) rows.

    One aggregate pass (partial aggregation per task, a single final row),
    then a ``stack`` to turn the row into one row per required column.
    """
    required = [c for c in contract.required if c in df.columns]
    if not required:
        return df.sparkSession.createDataFrame([], "column_name string, null_count long")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = ", ".join(f"'{c}', `{c}`" for c in required)
    return counts.selectExpr(f"stack({len(required)}, {pairs}) AS (column_name, null_count)")


NOT_NULL_MARKER = "NOT NULL violated"


def enforce_not_null(df: DataFrame, contract: Contract) -> DataFrame:
    """C6 inside the plan: a required column that is null raises when the row is
    produced, so a write fails (and never commits) instead of needing a separate
    counting job over the same data before it.  Schema problems are still
    reported at plan time."""
    problems = schema_diff(df, contract)
    if problems:
        raise ValueError(f"{contract.name} does not match its contract: {problems}")
    req = set(contract.required)
    return df.select(*[
        F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{NOT_NULL_MARKER}: {contract.name}.{c}")))
         .otherwise(F.col(c)).alias(c) if c in req else F.col(c)
        for c in df.columns])


def assert_conforms(df: DataFrame, contract: Contract) -> None:
    """Raise ``ValueError`` when ``df`` breaks the contract (schema or NOT NULL).

    Stored NOT NULL is not enforced by Parquet tables, so this runs before
    every publish.
    """
    problems = schema_diff(df, contract)
    if problems:
        raise ValueError(f"{contract.name} does not match its contract: {problems}")
    bad = [(r.column_name, r.null_count) for r in null_violations(df, contract).collect() if r.null_count]
    if bad:
        raise ValueError(f"{contract.name} has nulls in NOT NULL columns: {bad}")
