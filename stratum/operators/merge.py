"""Upsert and insert-only as pure DataFrame operators.

Open Spark has no row-level MERGE on Parquet, so a merge is expressed as the
*next state* of the target: ``upsert(target, source) -> DataFrame``.  A sink
(``stratum.sources.tables.SnapshotTable``) then publishes that state as a new
table version.

Physical shape: one full outer equi-join on the business key (sort-merge or
shuffled hash; both sides hash-partitioned on the key, so each side is
shuffled at most once) followed by one projection of ``CASE WHEN`` per
column.  When no column is preserved from the target, the same state is
``source ∪ (target anti-join source keys)``, which shuffles only the
source's key columns.
Business keys are unique per side, so no key is hot; null key parts are
compared null-safely (``<=>``), which Catalyst still plans as an equi-join
on ``coalesce(k, default), isnull(k)``.

Presence of a row on each side is tracked with a literal flag column
(``_in_t`` / ``_in_s``), never by testing a key for null, because a key part
may legitimately be null (inventory ``storage_location``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.predicates import not_null
from stratum.operators.columns import validate_columns

_IN_T, _IN_S = "_in_t", "_in_s"


def merge_condition(
    keys: Sequence[str], target: DataFrame, source: DataFrame, null_safe: bool = True,
    nullable_keys: Sequence[str] | None = None,
) -> list[Column]:
    """One equality per key (``<=>`` when ``null_safe``); empty keys are an error.

    ``nullable_keys`` narrows ``<=>`` to the key columns that may hold nulls
    (from the contract).  A plain ``=`` on the others is the same predicate
    for non-null values and keeps the join keyed on the bare columns, so the
    join can reuse a hash partitioning already produced on the business key
    (the top-1 window's shuffle) instead of shuffling again on
    ``coalesce(k, ''), isnull(k)``.
    """
    keys = list(keys)
    if not keys:
        raise ValueError("A merge needs one key column or more.")
    safe = set(keys if nullable_keys is None else nullable_keys) if null_safe else set()
    return [target[k].eqNullSafe(source[k]) if k in safe else target[k] == source[k] for k in keys]


def _check_same_columns(target: DataFrame, source: DataFrame) -> None:
    if set(target.columns) != set(source.columns):
        raise ValueError(
            "Source and target columns differ: "
            f"only in source {sorted(set(source.columns) - set(target.columns))}, "
            f"only in target {sorted(set(target.columns) - set(source.columns))}"
        )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    exclude_update_columns: Iterable[str] = (),
    null_safe: bool = True,
    nullable_keys: Sequence[str] | None = None,
) -> DataFrame:
    """The target after ``MERGE ... WHEN MATCHED UPDATE / WHEN NOT MATCHED INSERT``.

    * matched rows take every source column except ``exclude_update_columns``,
      which keep the target value (B4; keys are never excluded implicitly);
    * unmatched source rows are inserted with all their columns;
    * unmatched target rows are kept as they are; nothing is deleted (D12);
    * an empty source returns the target unchanged (B7 — no pre-check needed,
      the outer join of an empty side is the other side);
    * ``null_safe=False`` reproduces the reference's plain ``=``: a row whose
      key has a null part never matches and is inserted again (D5);
    * ``nullable_keys`` (see ``merge_condition``) limits ``<=>`` to the key
      columns that can be null.

    The output has the target's column order.
    """
    keys = list(keys)
    validate_columns(target, keys)
    validate_columns(source, keys)
    _check_same_columns(target, source)
    keep = set(exclude_update_columns)
    if not keep:
        # Nothing kept from the target on a match: the merged state is every
        # source row plus the target rows whose key the source does not have.
        # Only the source's key columns go through the anti join's shuffle,
        # instead of whole source rows through a full outer join.
        t, sk = target.alias("t"), source.select(*keys).alias("s")
        unmatched = t.join(sk, on=merge_condition(keys, t, sk, null_safe, nullable_keys), how="left_anti")
        return source.select(*target.columns).unionByName(unmatched.select(*target.columns))
    t = target.withColumn(_IN_T, F.lit(True)).alias("t")
    s = source.withColumn(_IN_S, F.lit(True)).alias("s")
    cond = merge_condition(keys, t, s, null_safe, nullable_keys)
    joined = t.join(s, on=cond, how="full_outer")
    from_source = F.col(f"s.{_IN_S}").isNotNull()
    from_target = F.col(f"t.{_IN_T}").isNotNull()
    exprs = []
    for c in target.columns:
        tc, sc = F.col(f"t.`{c}`"), F.col(f"s.`{c}`")
        if c in keep:
            e = F.when(from_target, tc).otherwise(sc)
        else:
            e = F.when(from_source, sc).otherwise(tc)
        exprs.append(e.alias(c))
    return joined.select(*exprs)


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """B5 core: source rows whose key is absent from the target (left anti join).

    Default ``null_safe=False`` follows the reference (plain ``=``), so a key
    with a null part is always "absent".
    """
    keys = list(keys)
    validate_columns(target, keys)
    validate_columns(source, keys)
    t = target.select(*keys).alias("t")
    s = source.alias("s")
    cond = merge_condition(keys, t, s, null_safe)
    return s.join(t, on=cond, how="left_anti").select(*[F.col(f"s.`{c}`") for c in source.columns])


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The target after inserting the absent keys; matched target rows never change.

    As a sink this is an *append* of ``new_rows`` — the target is not rewritten.
    """
    _check_same_columns(target, source)
    return target.unionByName(new_rows(target, source, keys, null_safe).select(*target.columns))


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key tuples that occur more than once (partial + final aggregate)."""
    keys = list(keys)
    validate_columns(source, keys)
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique_keys(source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> None:
    """Fail before a merge whose source has two rows for one key.

    One aggregation job; ``limit(1)`` lets Spark stop at the first duplicate.
    Where the merge compares with plain ``=``, keys with a null part match nothing
    and are not looked at.
    """
    if not null_safe:
        source = source.filter(not_null(list(keys)))
    dup = duplicate_keys(source, keys).limit(1).collect()
    if dup:
        raise ValueError(f"Merge source has duplicate keys, e.g. {dup[0].asDict()}")


def count_unique_keys(source: DataFrame, keys: Sequence[str], null_safe: bool = True) -> int:
    """The number of rows, after ``assert_unique_keys``.

    Counted are hashes of eight bytes, not the keys; the keys are only looked
    at if a hash comes twice.
    """
    keys = list(keys)
    validate_columns(source, keys)
    hashes = source.groupBy(F.xxhash64(*keys).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    found = hashes.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    if (found["most"] or 0) > 1:
        assert_unique_keys(source, keys, null_safe)
    return found["rows"] or 0
