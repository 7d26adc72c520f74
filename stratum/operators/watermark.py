"""High-water mark and incremental read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.columns import validate_columns


def high_water_mark_frame(df: DataFrame, column: str, alias: str = "max_timestamp") -> DataFrame:
    """H1 as a one-row DataFrame (global max; null on an empty table).

    The aggregate is partial per task, so only one value per task reaches
    the single final reducer.
    """
    validate_columns(df, [column])
    return df.agg(F.max(column).alias(alias))


def high_water_mark(df: DataFrame, column: str):
    """H1 + K2: the mark as a driver value (one scalar), ``None`` when empty."""
    return high_water_mark_frame(df, column).first()[0]


def incremental_filter(raw: DataFrame, mark, column: str = "ingestion_timestamp") -> DataFrame:
    """rows strictly after the mark; everything when the mark is null.

    Applied to the raw column before any cleaning, so Parquet can compare it
    with row-group statistics; these exist if the files hold timestamps as
    microseconds (``session.DEFAULTS``), not as INT96.
    """
    validate_columns(raw, [column])
    if mark is None:
        return raw
    return raw.filter(F.col(column) > F.lit(mark))


def incremental_after(raw: DataFrame, target: DataFrame, mark_column: str,
                      column: str = "ingestion_timestamp", date_column: str | None = None) -> DataFrame:
    """F6 without a driver round trip: filter against the target's mark as a scalar subquery.

    ``max`` over an empty target is null; ``coalesce`` to the first year keeps
    "null mark = full read" (of rows that have a timestamp, as every ingested
    row does) in one comparison that Parquet accepts.  Spark evaluates the
    uncorrelated scalar subquery once before the scan.

    ``date_column`` names a partition column of ``raw`` that holds the date of
    ``column``: folders of days before the mark's are then not listed for the
    scan at all (rows of the mark's own day are compared one by one).
    """
    validate_columns(raw, [column])
    validate_columns(target, [mark_column])
    mark = target.agg(F.max(mark_column).alias("m")).scalar()
    after = F.coalesce(mark, F.lit("0001-01-01 00:00:00").cast("timestamp"))
    if date_column is not None:
        validate_columns(raw, [date_column])
        raw = raw.filter(F.col(date_column) >= F.to_date(after))
    return raw.filter(F.col(column) > after)
