"""Catalog tables from contracts (B8), SQL preview (A4) and the row-level merge sink.

``create_table_sql`` renders a contract as ``CREATE TABLE IF NOT EXISTS``
with NOT NULL, column comments and a table comment (quotes doubled).  On a
Parquet table Spark accepts but does not enforce NOT NULL, which is why
every publish runs the conformance check (C6).

``merge_into`` is the sink for catalogs whose tables support row-level
operations (Delta Lake, Iceberg): the MERGE rewrites only the files holding
matched keys, which is the scalable form of B3 at large table sizes.  On a
plain Parquet table Spark refuses MERGE; use ``SnapshotTable`` there.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import Contract
from stratum.operators.merge import assert_unique_keys


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def create_table_sql(contract: Contract, table_name: str, using: str = "parquet", location: str | None = None,
                     partitioned_by: Sequence[str] = ()) -> str:
    """DDL for one contract table."""
    cols = []
    for c in contract.columns:
        line = f"`{c.name}` {c.dtype.simpleString().upper()}"
        if not c.nullable:
            line += " NOT NULL"
        if c.comment:
            line += f" COMMENT {_quote(c.comment)}"
        cols.append(line)
    sql = f"CREATE TABLE IF NOT EXISTS {table_name} (\n  " + ",\n  ".join(cols) + f"\n) USING {using}"
    if partitioned_by:
        sql += f"\nPARTITIONED BY ({', '.join(partitioned_by)})"
    if contract.comment:
        sql += f"\nCOMMENT {_quote(contract.comment)}"
    if location:
        sql += f"\nLOCATION {_quote(location)}"
    return sql


def create_tables(spark: SparkSession, contracts: Iterable[Contract], namespace_of=lambda c: c.layer,
                  using: str = "parquet", location_root: str | None = None) -> list[str]:
    """Create every contract table that does not exist yet; return the table names."""
    names = []
    for c in contracts:
        ns = namespace_of(c)
        db_loc = f" LOCATION {_quote(location_root.rstrip('/') + '/' + ns + '.db')}" if location_root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}{db_loc}")
        name = f"{ns}.{c.dataset}"
        loc = f"{location_root.rstrip('/')}/{c.layer}/{c.dataset}" if location_root else None
        spark.sql(create_table_sql(c, name, using, loc))
        names.append(name)
    return names


def missing_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """All missing tables at once (instead of failing on the first)."""
    return sorted(n for n in names if not spark.catalog.tableExists(n))


def assert_tables_exist(spark: SparkSession, names: Iterable[str]) -> None:
    """Raise one ``ValueError`` naming every missing table."""
    missing = missing_tables(spark, names)
    if missing:
        raise ValueError(f"Missing tables: {missing}")


def preview(spark: SparkSession, df: DataFrame, view: str, limit: int | None = None) -> DataFrame:
    """A4: register ``df`` as a temporary view and query it with SQL."""
    df.createOrReplaceTempView(view)
    sql = f"SELECT * FROM {view}" + (f" LIMIT {int(limit)}" if limit else "")
    return spark.sql(sql)


def merge_into(source: DataFrame, table_name: str, keys: Sequence[str], exclude_update_columns: Iterable[str] = (),
               null_safe: bool = True, check_unique: bool = True) -> None:
    """B3/B4 as a row-level MERGE: update matched rows (all source columns except the
    excluded ones), insert the others, never delete."""
    keys = list(keys)
    if not keys:
        raise ValueError("At least one merge key is required.")
    if check_unique:
        assert_unique_keys(source, keys)
    keep = set(exclude_update_columns)
    t, s = table_name.split(".")[-1], "s"
    tgt = source.sparkSession.table(table_name)
    op = (lambda a, b: a.eqNullSafe(b)) if null_safe else (lambda a, b: a == b)
    cond = None
    for k in keys:
        e = op(F.col(f"{t}.`{k}`"), F.col(f"{s}.`{k}`"))
        cond = e if cond is None else cond & e
    update = {c: F.col(f"{s}.`{c}`") for c in source.columns if c not in keep}
    if set(tgt.columns) != set(source.columns):
        raise ValueError("Source and target columns differ")
    (source.alias(s).mergeInto(table_name, cond)
        .whenMatched().update(update)
        .whenNotMatched().insertAll()
        .merge())
