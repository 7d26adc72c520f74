"""Raw supply-chain datasets derived from the provided test tables.

The reference ships no data; these rules turn the TPC-H-like tables into the
six Raw datasets so every pipeline runs on inputs whose size grows with the
scale factor.  Only ``concat``, ``%``, ``CASE``, ``lower`` and casts are used,
so the DuckDB oracle can reproduce every value.  Each dataset is one scan
(plus a join with small dimension tables for supplier / plant / purchase
order) and one projection; nothing is collected.

Fixed values shared with the oracle SQL: source system ``sap``, landing file
names, batch ids ``fixture-1`` / ``fixture-2``, ingestion date ``2024-01-01``
(``2024-01-02`` for second material versions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.contracts import contract
from stratum.operators.columns import align_to_contract
from stratum.session import fit_partitions

SOURCE_SYSTEM = "sap"
BASE_TS = "2024-01-01 00:00:00"
SECOND_TS = "2024-01-02 00:00:00"


_LOADED: dict[tuple[str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one read-only test table.  The DataFrame is kept per session so
    repeated plans do not list the folder and read the footer again."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _LOADED:
        fit_partitions(spark, path)
        _LOADED[key] = spark.read.parquet(path)
    return _LOADED[key]


def _s(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _s(p) for p in parts])


def _meta(file: str, batch: str, ts: Column) -> dict[str, Column]:
    return {
        "source_system": F.lit(SOURCE_SYSTEM),
        "source_file": F.lit(file),
        "ingestion_batch_id": F.lit(batch),
        "ingestion_timestamp": ts.cast("timestamp"),
    }


def _raw(df: DataFrame, dataset: str, cols: dict[str, Column]) -> DataFrame:
    return align_to_contract(df.select(*[v.alias(k) for k, v in cols.items()]), contract(dataset, "raw"), strict=True)


def raw_material(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    k = F.col("p_partkey")

    def version(df: DataFrame, suffix: str, batch: str, ts: str) -> DataFrame:
        return _raw(df, "material", {
            "material_id": F.when(k % 97 == 0, F.lit("N/A")).when(k % 89 == 0, F.lit(""))
                            .otherwise(_cat("  mat-", k, " ")),
            "material_name": F.when(k % 83 == 0, F.lit("NULL")).otherwise(F.concat(F.col("p_name"), F.lit(suffix))),
            "material_type": F.lower("p_type"),
            "unit_of_measure": F.lit("ea"),
            "product_group": F.col("p_brand"),
            **_meta("part.parquet", batch, F.lit(ts)),
        })

    return version(part, "", "fixture-1", BASE_TS).unionByName(
        version(part.filter(k % 10 == 0), " v2", "fixture-2", SECOND_TS))


def raw_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = load(spark, sf_dir, "supplier")
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    df = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("s_suppkey")
    return _raw(df, "supplier", {
        "supplier_id": F.when(k % 23 == 5, F.lit(None)).otherwise(_cat(" sup-", k)),
        "supplier_name": F.when(k % 17 == 3, F.lit("")).otherwise(F.col("s_name")),
        "supplier_type": _cat("tier", k % 3),
        "city": _cat("  ", F.lower("n_name"), " "),
        "state": F.col("n_name"),
        "country": F.lower("r_name"),
        **_meta("supplier.parquet", "fixture-1", F.lit(BASE_TS)),
    })


def raw_plant(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = load(spark, sf_dir, "nation")
    r = load(spark, sf_dir, "region")
    df = n.join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("n_nationkey")
    return _raw(df, "plant", {
        "plant_id": F.when(k == 7, F.lit("NA")).otherwise(_cat("plt-", k)),
        "plant_name": F.when(k == 11, F.lit(" ")).otherwise(F.col("n_name")),
        "plant_type": F.when(k % 2 == 0, F.lit("dc")).otherwise(F.lit("mfg")),
        "city": F.lower("n_name"),
        "state": F.when(F.col("n_regionkey") == 0, F.lit("N/A")).otherwise(_cat("st-", F.col("n_regionkey"))),
        "country": F.lower("r_name"),
        **_meta("nation.parquet", "fixture-1", F.lit(BASE_TS)),
    })


def raw_purchase_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer")
    df = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    ok = F.col("l_orderkey")
    return _raw(df, "purchase_order", {
        "purchase_order_id": _cat(" po-", ok),
        "purchase_order_line": _s("l_linenumber"),
        "material_id": _cat("mat-", F.col("l_partkey"), " "),
        "supplier_id": F.when(ok % 50 == 0, F.lit("")).otherwise(_cat("sup-", F.col("l_suppkey"))),
        "plant_id": _cat("PLT-", F.col("c_nationkey")),
        "order_date": F.col("o_orderdate").cast("date"),
        "requested_delivery_date": F.col("l_shipdate").cast("date"),
        "order_quantity": F.col("l_quantity").cast("decimal(18,4)"),
        "unit_of_measure": F.lit("ea"),
        "order_status": F.col("o_orderstatus"),
        **_meta("lineitem.parquet", "fixture-1", F.col("l_shipdate")),
    })


def raw_shipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    m = ok % 20
    po_id = _cat(" po-", ok)
    return _raw(li, "shipment", {
        "shipment_id": _cat("shp-", ok, "-", ln),
        "purchase_order_id": F.when(m == 0, F.lit(None)).when(m == 1, F.lit(""))
                               .when(m == 3, F.lit("po-none")).otherwise(po_id),
        "purchase_order_line": F.when((m == 0) | (m == 2), F.lit(None)).when(m == 1, F.lit("")).otherwise(_s(ln)),
        "material_id": _cat("mat-", F.col("l_partkey")),
        "supplier_id": _cat("sup-", F.col("l_suppkey")),
        "plant_id": _cat("plt-", F.col("l_suppkey") % 25),
        "shipment_date": F.col("l_shipdate").cast("date"),
        "actual_delivery_date": F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date")),
        "shipped_quantity": F.col("l_quantity").cast("decimal(18,4)"),
        "received_quantity": F.col("l_quantity").cast("decimal(18,4)"),
        "shipment_status": F.col("l_returnflag"),
        "carrier_name": _cat(" Carrier ", F.col("l_suppkey") % 7, " "),
        "transport_mode": F.when(ln % 3 == 0, F.lit("road")).when(ln % 3 == 1, F.lit("sea")).otherwise(F.lit("air")),
        **_meta("lineitem.parquet", "fixture-1", F.col("l_shipdate")),
    })


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    eid = F.col("event_id")
    return _raw(ev, "inventory", {
        "inventory_snapshot_date": F.when(eid % 101 == 0, F.lit(None)).otherwise(F.col("ts").cast("date")),
        "material_id": _cat(" mat-", eid % 5),
        "plant_id": _cat("plt-", F.col("user_id") % 5 + 5),
        "storage_location": F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("event_type")),
        "available_quantity": F.col("value").cast("decimal(18,4)"),
        "blocked_quantity": F.lit(None),
        "in_transit_quantity": (F.col("user_id") % 3).cast("decimal(18,4)"),
        "unit_of_measure": F.lit("ea"),
        **_meta("events.parquet", "fixture-1", F.col("ts")),
    })


BUILDERS = {
    "material": raw_material,
    "plant": raw_plant,
    "supplier": raw_supplier,
    "purchase_order": raw_purchase_order,
    "shipment": raw_shipment,
    "inventory": raw_inventory,
}


def raw(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    if dataset not in BUILDERS:
        raise ValueError(f"Unknown dataset: {dataset}")
    return BUILDERS[dataset](spark, sf_dir)


def raw_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in BUILDERS.items()}
