"""Latest record per business key (W1/W2, F7, K1) and distinct key sets.

``latest_per_key`` is ``row_number() over (partition by keys order by ...) = 1``
written so that Catalyst's ``InsertWindowGroupLimit`` rule fires: the physical
plan becomes ``WindowGroupLimit(Partial)`` before the shuffle and
``WindowGroupLimit(Final)`` after it.  The partial step keeps at most one row
per key per input task, so a hot key (even one holding a third of all rows)
ships at most one row per map task through the shuffle instead of all of
them — the map-side combine that makes the window skew-tolerant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.columns import validate_columns

_RN = "_row_number"


def _order(col: str | Column, descending: bool) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_column: str,
    tiebreak: Sequence[str] = (),
    tiebreak_descending: bool = True,
) -> DataFrame:
    """Keep one row per ``keys``: the latest by ``order_column``.

    * order column descending, nulls last (``desc()`` in Spark is nulls last too);
    * null key parts form their own group (window partitioning is null-safe);
    * ``tiebreak`` columns (D6) make the winner deterministic when the order
      column ties — all rows of one micro-batch share ``ingestion_timestamp``.
      They sort descending with nulls last by default, the same direction as
      the order column.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("At least one key column is required.")
    validate_columns(df, [*keys, order_column, *tiebreak])
    window = Window.partitionBy(*keys).orderBy(
        _order(order_column, True), *[_order(c, tiebreak_descending) for c in tiebreak]
    )
    return df.withColumn(_RN, F.row_number().over(window)).filter(F.col(_RN) == 1).drop(_RN)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct key tuples of a table (partial + final hash aggregate)."""
    keys = list(keys)
    validate_columns(df, keys)
    return df.select(*keys).dropDuplicates()
