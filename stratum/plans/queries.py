"""The registered queries: each one runs an operator or a pipeline over the
Raw datasets derived from the test tables in ``sf_dir`` (whole tables).

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  Run
times are fixed literals so results are reproducible; the scenario cut-offs
(``PO_CUTOFF`` etc.) split the data by ingestion time into a first and a
second delivery, as a daily job would see it.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.contracts import contract, DATASETS, payload_columns
from stratum.functions import clean
from stratum.functions.predicates import requirement
from stratum.operators import columns as cols
from stratum.operators import merge, refcheck, rejects
from stratum.operators.dedupe import distinct_keys, latest_per_key
from stratum.operators.watermark import high_water_mark_frame, incremental_after
from stratum.plans import foundation as fnd
from stratum.plans import trusted as trs
from stratum.plans.jobs import together
from stratum.plans.specs import SPECS, TRUSTED_ORDER, spec
from stratum.session import pin_utc
from stratum.sources import fixtures

RUN_TS = "2024-06-30 00:00:00"
RUN_TS_1 = "2024-06-01 00:00:00"
RUN_TS_0 = "2024-05-01 00:00:00"
PO_CUTOFF = "1998-01-01 00:00:00"
PO_CUTOFF_0 = "1996-01-01 00:00:00"
CSV_NULL = "\\N"  # null in the landing files
BUCKETS = 4  # least number of key buckets of the published tables
INV_BATCH1_END = "2024-01-20 00:00:00"
INV_BATCH2_START = "2024-01-15 00:00:00"


def ts(value: str):
    return F.lit(value).cast("timestamp")


def comparable(df: DataFrame) -> DataFrame:
    """Presentation for the cross-engine check: DATE -> TIMESTAMP, DECIMAL -> DOUBLE.

    Both conversions are exact and identical in Spark and DuckDB; they only
    give the two engines' pandas results the same value types.
    """
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def _raw(spark, sf_dir, name):
    pin_utc(spark)
    return fixtures.raw(spark, sf_dir, name)


def foundation_df(spark, sf_dir, name, run_ts=RUN_TS) -> DataFrame:
    return fnd.foundation(spec(name), _raw(spark, sf_dir, name), ts(run_ts))


def trusted_all(spark, sf_dir, run_ts=RUN_TS) -> dict[str, DataFrame]:
    """P14 in memory: six Foundation plans, then Trusted in dependency order."""
    out: dict[str, DataFrame] = {}
    for name in TRUSTED_ORDER:
        out[name] = trs.trusted(spec(name), foundation_df(spark, sf_dir, name, run_ts), out)
    return out


def trusted_df(spark, sf_dir, name) -> DataFrame:
    needs = {"material": ["material"], "plant": ["plant"], "supplier": ["supplier"],
             "purchase_order": ["material", "supplier", "plant", "purchase_order"],
             "shipment": ["material", "supplier", "plant", "purchase_order", "shipment"],
             "inventory": ["material", "plant", "inventory"]}[name]
    out: dict[str, DataFrame] = {}
    for d in needs:
        out[d] = trs.trusted(spec(d), foundation_df(spark, sf_dir, d), out)
    return out[name]


# --- scalar expressions ------------------------------------------------------------

def q_trim_upper_keys(spark, sf_dir):
    """E1, E2, E5, E8 on every Raw material row (no filter)."""
    s = SPECS["material"]
    raw = _raw(spark, sf_dir, "material")
    df = clean.standardize(raw.withColumn("source_record_id", clean.record_id_copy("material_id")),
                           trim=s.trim, null_tokens=s.null_tokens, upper=s.upper)
    return df.select("source_record_id", "material_id", "material_name", "material_type", "unit_of_measure",
                     "product_group", "source_system", "ingestion_timestamp")


def q_lowercase_columns(spark, sf_dir):
    """E3 on Raw suppliers."""
    raw = _raw(spark, sf_dir, "supplier")
    df = clean.lowercase_columns(raw, ["supplier_id", "supplier_name", "state", "source_system"])
    return df.select("supplier_id", "supplier_name", "supplier_type", "state", "country", "source_system")


def q_nullify_empty(spark, sf_dir):
    """E4 on the shipment PO reference (the optional pre-step of D10)."""
    raw = _raw(spark, sf_dir, "shipment")
    df = clean.nullify_empty_strings(raw, ["purchase_order_id", "purchase_order_line"])
    return df.select("shipment_id", "purchase_order_id", "purchase_order_line")


def q_normalize_nulls(spark, sf_dir):
    """E5 alone: tokens become null, other values stay untrimmed."""
    raw = _raw(spark, sf_dir, "plant")
    df = clean.normalize_null_values(raw, ["plant_id", "plant_name", "state", "source_system"])
    return df.select("plant_id", "plant_name", "state", "country", "source_system")


def q_record_id_concat_skip_null(spark, sf_dir):
    """E9 on raw shipment PO references (null parts left out)."""
    raw = _raw(spark, sf_dir, "shipment")
    return raw.select("shipment_id", clean.record_id_concat_skip_null(
        ["purchase_order_id", "purchase_order_line"]).alias("po_record_id"))


def q_record_id_concat_keep_empty(spark, sf_dir):
    """E10 on standardised inventory rows (null parts kept as empty)."""
    s = SPECS["inventory"]
    df = clean.standardize(_raw(spark, sf_dir, "inventory"), trim=s.trim, upper=s.upper)
    rid = clean.record_id_concat_keep_empty(["inventory_snapshot_date", "material_id", "plant_id", "storage_location"])
    return df.select("material_id", "plant_id", "storage_location", "ingestion_timestamp", rid.alias("source_record_id"))


# --- filters, windows, aggregates ---------------------------------------------------

def q_required_columns_filter(spark, sf_dir):
    """F2 on standardised purchase orders."""
    s = SPECS["purchase_order"]
    df = fnd.standardized(s, _raw(spark, sf_dir, "purchase_order"))
    return df.filter(requirement(s.present, s.not_null)).drop("ingestion_batch_id")


def q_latest_per_key(spark, sf_dir):
    """W1 over valid purchase orders with the spec's tie-break."""
    s = SPECS["purchase_order"]
    df = fnd.key_filter(s, fnd.standardized(s, _raw(spark, sf_dir, "purchase_order")))
    out = latest_per_key(df, s.keys, "ingestion_timestamp", s.dedupe_tiebreak())
    return out.select(*s.keys, "ingestion_timestamp", "material_id", "supplier_id", "order_quantity",
                      "source_record_id")


def _po_batch1(spark, sf_dir, run_ts=RUN_TS_1):
    raw = _raw(spark, sf_dir, "purchase_order").filter(F.col("ingestion_timestamp") <= ts(PO_CUTOFF))
    return fnd.foundation(SPECS["purchase_order"], raw, ts(run_ts))


def q_high_water_mark(spark, sf_dir):
    """H1 on the Foundation purchase orders published by the first delivery."""
    return high_water_mark_frame(_po_batch1(spark, sf_dir), "source_ingestion_timestamp")


def q_incremental_filter(spark, sf_dir):
    """Raw purchase-order rows after the published mark (none of them at or before it)."""
    raw = _raw(spark, sf_dir, "purchase_order")
    out = incremental_after(raw, _po_batch1(spark, sf_dir), "source_ingestion_timestamp")
    return out.drop("ingestion_batch_id")


def q_distinct_keys(spark, sf_dir):
    """Distinct (source_system, material_id) referenced by Foundation purchase orders."""
    return distinct_keys(foundation_df(spark, sf_dir, "purchase_order"), ["source_system", "material_id"])


def q_align_to_contract(spark, sf_dir):
    """A landing frame with reordered, string-typed, malformed, extra and missing
    columns aligned by name to the Raw shipment contract (try_cast: bad -> null)."""
    pin_utc(spark)
    return cols.align_to_contract(_landed_shipments(spark, sf_dir), contract("shipment", "raw"))


def _landed_shipments(spark, sf_dir):
    """Shipments as they land: text, in another column order, some values malformed."""
    li = fixtures.load(spark, sf_dir, "lineitem")
    ok = F.col("l_orderkey")
    return li.select(
        F.when(ok % 13 == 0, F.lit("abc")).otherwise(F.col("l_quantity").cast("string")).alias("shipped_quantity"),
        F.concat(F.lit("shp-"), ok.cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("shipment_id"),
        F.when(ok % 11 == 0, F.lit("2024-13-01")).otherwise(F.col("l_shipdate").cast("date").cast("string"))
         .alias("shipment_date"),
        F.col("l_returnflag").alias("shipment_status"),
        F.col("l_linestatus").alias("foo"),
        F.lit("sap").alias("source_system"),
        F.col("l_shipdate").alias("ingestion_timestamp"),
    )


def q_ingestion_failed_casts(spark, sf_dir):
    """Malformed landing values by column: how many the Raw table rescued as not
    castable, and how many nulls it holds."""
    from stratum.session import scratch_path
    from stratum.streaming.ingest import IngestionConfig, failed_casts, ingest_raw, raw_paths, read_raw

    pin_utc(spark)
    root = scratch_path(spark, "casts")
    _landed_shipments(spark, sf_dir).write.option("header", True).csv(f"{root}/landing")
    cfg = IngestionConfig("shipment", f"{root}/landing", source_system=fixtures.SOURCE_SYSTEM)
    ingest_raw(spark, cfg, *raw_paths(root, "shipment"))
    counts = failed_casts(spark, raw_paths(root, "shipment")[0], contract("shipment", "raw"))
    nulls = read_raw(spark, root, "shipment").agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in sorted(counts)])
    return nulls.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(n).cast("long").alias("failed_casts"), F.col(c).alias("null_values"))
        for c, n in sorted(counts.items())])).alias("r")).select("r.*")


LANDED_FILES = 110  # more micro-batches than a query keeps reports of


def q_rescued_values(spark, sf_dir):
    """Landing files with malformed values and a column that the contract does not have, one
    micro-batch for each file: the rescued values by column, kind and value."""
    from stratum.session import scratch_path
    from stratum.streaming.ingest import IngestionConfig, ingest_raw, raw_paths, rescued_values

    pin_utc(spark)
    root = scratch_path(spark, "rescued")
    rows = _landed_shipments(spark, sf_dir).drop("ingestion_timestamp")
    rows.repartition(LANDED_FILES).write.option("header", True).csv(f"{root}/landing")
    cfg = IngestionConfig("shipment", f"{root}/landing", source_system=fixtures.SOURCE_SYSTEM, options={"maxFilesPerTrigger": "1"})
    data, checkpoint = raw_paths(root, "shipment")
    ingest_raw(spark, cfg, data, checkpoint)
    found = rescued_values(spark, data, contract("shipment", "raw"))
    return found.groupBy("column_name", "kind", "value").agg(F.count(F.lit(1)).alias("rows"))


def q_streamed_latest_purchase_order(spark, sf_dir):
    """J2, J6, W1 in a stream: Raw files arrive in three parts in no order of their rows; two
    available-now runs and a running query keep one state, and the result is that of the batch job."""
    from stratum.plans import layered
    from stratum.session import scratch_path
    from stratum.streaming.foundation import latest_stream
    from stratum.streaming.ingest import DATE_COLUMN

    s, root = SPECS["purchase_order"], scratch_path(spark, "late")
    raw = _raw(spark, sf_dir, "purchase_order").withColumn(DATE_COLUMN, F.to_date("ingestion_timestamp"))
    table = layered.tables(spark, root, "foundation", BUCKETS)["purchase_order"]
    for part in range(3):
        arrived = raw.where(F.pmod(F.xxhash64("purchase_order_id", "purchase_order_line", "ingestion_timestamp"), F.lit(3)) == part)
        arrived.write.mode("append").parquet(f"{root}/raw")
        query = latest_stream(spark, s, f"{root}/raw", table, f"{root}/checkpoint", ts(RUN_TS), continuous=part == 2)
        if part == 2:
            try:
                query.processAllAvailable()
            finally:
                query.stop()
    return table.read()


# --- joins ----------------------------------------------------------------------------

def q_ref_check_mandatory(spark, sf_dir):
    """G1: Foundation purchase orders whose material is in Trusted material."""
    f = foundation_df(spark, sf_dir, "purchase_order")
    m = trs.trusted(SPECS["material"], foundation_df(spark, sf_dir, "material"))
    return refcheck.check_mandatory(f, m, ["source_system", "material_id"])


def q_ref_check_optional(spark, sf_dir):
    """G2 + F5: Foundation shipments with no PO reference or an existing Trusted PO."""
    f = foundation_df(spark, sf_dir, "shipment")
    po = trusted_df(spark, sf_dir, "purchase_order")
    return refcheck.check_optional(f, po, ["source_system", "purchase_order_id", "purchase_order_line"],
                                   ["purchase_order_id", "purchase_order_line"])


def q_reference_rejects(spark, sf_dir):
    """Rows each mandatory check drops, counted per (dataset, reference), each check alone."""
    t = {d: trs.trusted(spec(d), foundation_df(spark, sf_dir, d)) for d in ("material", "supplier", "plant")}
    parts = []
    for d in ("purchase_order", "shipment", "inventory"):
        checks = [(r.dataset, t[r.dataset], r.keys, ()) for r in spec(d).references if not r.optional]
        parts.append(refcheck.orphan_counts(foundation_df(spark, sf_dir, d), checks, "rejected_rows")
                     .select(F.lit(d).alias("dataset"), "reference", "rejected_rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _masters_after(spark, sf_dir):
    """Trusted masters of a later Raw delivery in which every id that ends in 7 has lost its name."""
    out = {}
    for d in ("material", "plant", "supplier"):
        raw = _raw(spark, sf_dir, d)
        lost = F.trim(f"{d}_id").endswith("7")
        raw = raw.withColumn(f"{d}_name", F.when(~F.coalesce(lost, F.lit(False)), F.col(f"{d}_name")))
        out[d] = trs.trusted(spec(d), fnd.foundation(spec(d), raw, ts(RUN_TS)))
    return out


def q_published_audit(spark, sf_dir):
    """Published Trusted fact rows whose reference is no longer valid after a later
    delivery of the masters, counted per (dataset, reference)."""
    t, now = trusted_all(spark, sf_dir), _masters_after(spark, sf_dir)
    now["purchase_order"] = trs.trusted(spec("purchase_order"), foundation_df(spark, sf_dir, "purchase_order"), now)
    parts = []
    for d in ("purchase_order", "shipment", "inventory"):
        checks = [(r.dataset, now[r.dataset], r.keys, r.optional) for r in spec(d).references]
        parts.append(refcheck.orphan_counts(t[d], checks).select(F.lit(d).alias("dataset"), "reference", "orphan_rows"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


LOST_AT = "2024-01-15 00:00:00"


def master_versions(spark, sf_dir, name: str) -> DataFrame:
    """Every version of a master with its time and whether Trusted takes it: the Raw versions, and at
    ``LOST_AT`` one more of each, in which ids ending in 7 have lost their name."""
    s, raw = SPECS[name], _raw(spark, sf_dir, name)
    lost = F.coalesce(F.trim(f"{name}_id").endswith("7"), F.lit(False))
    later = fnd.latest(s, fnd.key_filter(s, fnd.standardized(s, raw.withColumn(f"{name}_name", F.when(~lost, F.col(f"{name}_name"))))))
    rows = fnd.key_filter(s, fnd.standardized(s, raw)).unionByName(later.select(*raw.columns, fnd.RECORD_ID).withColumn("ingestion_timestamp", ts(LOST_AT)))
    return rows.withColumn("valid", F.coalesce(requirement(s.trusted_present, s.trusted_not_null), F.lit(False)))


def q_reference_then_and_now(spark, sf_dir):
    """Inventory rows by whether their references were valid at the snapshot's date and whether they are now."""
    from stratum.operators.asof import as_of

    parts = []
    for r in SPECS["inventory"].references:
        versions = master_versions(spark, sf_dir, r.dataset)
        now = latest_per_key(versions, r.keys, "ingestion_timestamp", ("valid",)).where("valid").select(*r.keys)
        rows = as_of(foundation_df(spark, sf_dir, "inventory"), versions, r.keys, "inventory_snapshot_date", "ingestion_timestamp", ["valid"], "_then")
        rows = refcheck.flagged(rows, now, list(r.keys), [], "_now")
        verdicts = {"valid_then": F.coalesce("_then.valid", F.lit(False)), "valid_now": F.coalesce("_now", F.lit(False))}
        parts.append(rows.groupBy(F.lit(r.dataset).alias("reference"), *[c.alias(n) for n, c in verdicts.items()]).agg(F.count(F.lit(1)).alias("rows")))
    return parts[0].unionByName(parts[1])


# --- merges ----------------------------------------------------------------------------

def q_upsert_two_batches(spark, sf_dir):
    """Foundation PO after delivery 1, upserted with the incremental delivery 2."""
    s = SPECS["purchase_order"]
    target = _po_batch1(spark, sf_dir)
    raw2 = incremental_after(_raw(spark, sf_dir, "purchase_order"), target, "source_ingestion_timestamp")
    source = fnd.foundation(s, raw2, ts(RUN_TS))
    return merge.upsert(target, source, s.keys, s.preserve_on_update, nullable_keys=s.nullable_keys())


def q_upsert_preserve_created(spark, sf_dir):
    """Material first versions published at run 1, then all versions at run 2;
    record_created_timestamp keeps run 1 for keys that existed."""
    s = SPECS["material"]
    raw = _raw(spark, sf_dir, "material")
    target = fnd.foundation(s, raw.filter(F.col("ingestion_batch_id") == "fixture-1"), ts(RUN_TS_1))
    source = fnd.foundation(s, raw, ts(RUN_TS))
    return merge.upsert(target, source, s.keys, s.preserve_on_update, nullable_keys=s.nullable_keys())


def _inventory_batches(spark, sf_dir):
    s = SPECS["inventory"]
    raw = _raw(spark, sf_dir, "inventory")
    t = fnd.foundation(s, raw.filter(F.col("ingestion_timestamp") < ts(INV_BATCH1_END)), ts(RUN_TS_1))
    src = fnd.foundation(s, raw.filter(F.col("ingestion_timestamp") >= ts(INV_BATCH2_START)), ts(RUN_TS))
    return s, t, src


def q_upsert_null_key_safe(spark, sf_dir):
    """D5 fix: overlapping inventory deliveries; null storage keys match null-safely."""
    s, t, src = _inventory_batches(spark, sf_dir)
    return merge.upsert(t, src, s.keys, s.preserve_on_update, null_safe=True, nullable_keys=s.nullable_keys())


def q_upsert_null_key_plain(spark, sf_dir):
    """D5 parity: plain equality — null storage rows are inserted again."""
    s, t, src = _inventory_batches(spark, sf_dir)
    return merge.upsert(t, src, s.keys, (), null_safe=False)


def q_insert_only(spark, sf_dir):
    """Foundation PO after delivery 1 plus the keys first seen in the full Raw."""
    s = SPECS["purchase_order"]
    target = _po_batch1(spark, sf_dir)
    source = foundation_df(spark, sf_dir, "purchase_order")
    return merge.insert_only(target, source, s.keys)


# --- conformance ------------------------------------------------------------------------

def q_contract_conformance(spark, sf_dir):
    """Per Raw dataset, nulls in the columns its Foundation contract declares NOT NULL."""
    parts = []
    for d in DATASETS:
        raw = _raw(spark, sf_dir, d)
        parts.append(cols.null_violations(raw, contract(d, "foundation"))
                     .select(F.lit(d).alias("dataset"), "column_name", "null_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_sql_preview(spark, sf_dir):
    """A4: Raw plant registered as a temporary view and read back with SQL."""
    from stratum.sources.catalog import preview

    return preview(spark, _raw(spark, sf_dir, "plant"), "raw_plant_preview")


# --- publishing runs (write versioned tables under the shared checkpoint root) ---------

def q_published_trusted_shipment(spark, sf_dir):
    """P14 with sinks: all six Foundation and Trusted tables published in dependency
    order from empty tables; returns the published Trusted shipments."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    root = scratch_path(spark, "layered")
    layered.run_layered(spark, fixtures.raw_all(spark, sf_dir), root, ts(RUN_TS), buckets=BUCKETS)
    return layered.read_layer(spark, root, "trusted", BUCKETS)["shipment"]


def _first_delivery(name: str):
    """What the first of two deliveries holds: all plants and suppliers, first material
    versions, facts up to a cut-off.  The second one holds the rest."""
    return {"material": F.col("ingestion_batch_id") == "fixture-1",
            "purchase_order": F.col("ingestion_timestamp") <= ts(PO_CUTOFF),
            "shipment": F.col("ingestion_timestamp") <= ts(PO_CUTOFF),
            "inventory": F.col("ingestion_timestamp") < ts(INV_BATCH1_END)}.get(name, F.lit(True))


def two_deliveries(spark, sf_dir) -> list[tuple[str, dict[str, DataFrame]]]:
    """(run time, Raw rows) of each delivery."""
    raw = fixtures.raw_all(spark, sf_dir)
    return [(RUN_TS_1, {d: df.filter(_first_delivery(d)) for d, df in raw.items()}),
            (RUN_TS, {d: df.filter(~_first_delivery(d)) for d, df in raw.items()})]


def q_published_bucketed_trusted_shipment(spark, sf_dir):
    """P14 with bucketed change tables, two deliveries at two run times: the second one
    has late and changed rows only, publishes no supplier or plant, keeps the creation
    times of known keys and updates the others."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    root = scratch_path(spark, "bucketed")
    for run, delivery in two_deliveries(spark, sf_dir):
        layered.run_layered(spark, delivery, root, ts(run), buckets=BUCKETS)
    return layered.read_layer(spark, root, "trusted", BUCKETS)["shipment"]


def _late(column: str, digit: str):
    return F.coalesce(F.trim(column).endswith(digit), F.lit(False))


def three_deliveries(spark, sf_dir) -> list[tuple[str, dict[str, DataFrame]]]:
    """(run time, Raw rows) of each delivery.  Facts come by time; suppliers whose id ends in 3
    arrive with the second delivery and materials whose id ends in 7 with the third one, so facts
    that were rejected before become valid without having changed."""
    raw = fixtures.raw_all(spark, sf_dir)
    at = {"material": F.when(F.col("ingestion_batch_id") != "fixture-1", 2).when(_late("material_id", "7"), 3).otherwise(1),
          "plant": F.lit(1), "supplier": F.when(_late("supplier_id", "3"), 2).otherwise(1)}
    by_time = F.when(F.col("ingestion_timestamp") <= ts(PO_CUTOFF_0), 1).when(F.col("ingestion_timestamp") <= ts(PO_CUTOFF), 2).otherwise(3)
    names = [d for d in DATASETS if d != "inventory"]
    return [(run, {d: raw[d].filter(at.get(d, by_time) == n) for d in names}) for n, run in enumerate((RUN_TS_0, RUN_TS_1, RUN_TS), 1)]


def q_incremental_trusted_shipment(spark, sf_dir):
    """P10-P12, P14 over three deliveries, Trusted from the due Foundation rows only; the
    result is that of runs that take all of Foundation each time."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    root = scratch_path(spark, "due")
    for run, rows in three_deliveries(spark, sf_dir):
        layered.run_layered(spark, rows, root, ts(run), datasets=tuple(rows), take=layered.DUE, buckets=BUCKETS)
    return layered.read_layer(spark, root, "trusted", BUCKETS)["shipment"]


def q_waiting_trusted_shipment(spark, sf_dir):
    """The same three deliveries, Trusted from the Foundation rows that changed and the waiting
    rows that a reference of the delivery may free."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    root = scratch_path(spark, "waiting")
    for run, rows in three_deliveries(spark, sf_dir):
        layered.run_layered(spark, rows, root, ts(run), datasets=tuple(rows), take=layered.WAITING, buckets=BUCKETS)
    return layered.read_layer(spark, root, "trusted", BUCKETS)["shipment"]


def q_waiting_rows(spark, sf_dir):
    """What waits for a reference after the second of the three deliveries, in each fact table."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    root, facts = scratch_path(spark, "waiting"), ("purchase_order", "shipment")
    for run, rows in three_deliveries(spark, sf_dir)[:2]:
        layered.run_layered(spark, rows, root, ts(run), datasets=tuple(rows), take=layered.WAITING, buckets=BUCKETS)
    parts = [layered.waiting_table(spark, root, spec(d)).read().select(
        F.lit(d).alias("dataset"), "source_system", "source_record_id", "material_id", "supplier_id", "plant_id", "record_updated_timestamp") for d in facts]
    return parts[0].unionByName(parts[1])


def q_rejected_rows(spark, sf_dir):
    """Every row that a Foundation or Trusted job rejects, with all its reasons."""
    from stratum.session import scratch_path

    published, parts = {}, []
    referenced = {r.dataset for s in SPECS.values() for r in s.references}
    for d in TRUSTED_ORDER:
        s = spec(d)
        rows = trs.judged_rows(s, foundation_df(spark, sf_dir, d), published)
        if d in referenced:  # judged once: its rejects are returned, the others are what later datasets refer to
            folder = scratch_path(spark, "judged")
            rows.select(*dict.fromkeys([*s.keys, "source_record_id", rejects.REASONS])).write.parquet(folder)
            rows = spark.read.parquet(folder)
            published[d] = rejects.accepted(rows)
        for layer, rows in {"foundation": fnd.judged_rows(s, _raw(spark, sf_dir, d)), "trusted": rows}.items():
            # the record id of inventory is made after de-duplication
            record = F.col("source_record_id") if "source_record_id" in rows.columns else fnd.record_id_expr(s.record_id)
            parts.append(rejects.rejected(rows).select(
                F.lit(layer).alias("layer"), F.lit(d).alias("dataset"), record.alias("record_id"), F.array_join(rejects.REASONS, ", ").alias("reasons")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_incremental_publish_purchase_order(spark, sf_dir):
    """Purchase orders delivered in two parts (first up to PO_CUTOFF, then all of
    Raw) at two run times; the second run reads only rows after the published
    high-water mark and upserts them, keeping the creation times."""
    from stratum.plans import layered
    from stratum.session import scratch_path

    raw = _raw(spark, sf_dir, "purchase_order")
    table = layered.tables(spark, scratch_path(spark, "incremental"), "foundation", BUCKETS)["purchase_order"]
    for run, delivery in ((RUN_TS_1, raw.filter(_first_delivery("purchase_order"))), (RUN_TS, raw)):
        layered.foundation_step(spark, SPECS["purchase_order"], delivery, table, ts(run))
    return table.read()


def land_csv(raw: DataFrame, s, folder: str) -> None:
    """The payload of every row of ``raw`` as CSV files with a header, all versions of a key in one file.

    A landing file has no ingestion time, so Foundation tells versions that arrive together apart by
    its tie-break: the file, then the payload (D6).
    """
    names = payload_columns(s.name)
    copies = fnd.standardized(s, raw.withColumns({f"_landed_{c}": F.col(c).cast("string") for c in names}))
    (copies.repartition(*s.keys).select(*[F.col(f"_landed_{c}").alias(c) for c in names]).write.mode("append").option("header", True)
           .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("nullValue", CSV_NULL).csv(folder))


def _landed(spark, sf_dir, chosen: tuple[str, ...], wanted: str) -> DataFrame:
    """CSV files of the chosen datasets land in two drops; each time available-now streams ingest them (a
    last run finds no new file), Foundation is published from the new Raw files and Trusted from what changed."""
    from stratum.plans import layered
    from stratum.session import scratch_path
    from stratum.streaming.ingest import default_configs, run_raw_ingestion

    root = scratch_path(spark, "landing")
    configs = {d: replace(c, options={"nullValue": CSV_NULL})  # so that empty texts stay apart from nulls
               for d, c in default_configs(f"{root}/landing", source_system=fixtures.SOURCE_SYSTEM).items()}
    for run, delivery in two_deliveries(spark, sf_dir):
        together({d: partial(land_csv, delivery[d], SPECS[d], f"{root}/landing/{d}") for d in chosen})
        run_raw_ingestion(spark, configs, ",".join(chosen), root)
        layered.run_layered_incremental(spark, root, ts(run), datasets=chosen, buckets=BUCKETS)
    run_raw_ingestion(spark, configs, ",".join(chosen), root)
    return layered.read_layer(spark, root, "trusted", BUCKETS)[wanted]


def q_landing_to_trusted(spark, sf_dir):
    """A1, A2, J3, J5, P13, P14 from landing files, with every version of a row in its delivery, to Trusted shipments."""
    return _landed(spark, sf_dir, ("material", "plant", "supplier", "purchase_order", "shipment"), "shipment")


def q_landing_to_trusted_inventory(spark, sf_dir):
    """The same for inventory, whose key holds a date and a part that may be null."""
    return _landed(spark, sf_dir, ("material", "plant", "inventory"), "inventory")


def _layer_query(layer, name):
    if layer == "foundation":
        return lambda spark, sf_dir: foundation_df(spark, sf_dir, name)
    return lambda spark, sf_dir: trusted_df(spark, sf_dir, name)


QUERIES = {
    "trim_upper_keys": q_trim_upper_keys,
    "lowercase_columns": q_lowercase_columns,
    "nullify_empty": q_nullify_empty,
    "normalize_nulls": q_normalize_nulls,
    "record_id_concat_skip_null": q_record_id_concat_skip_null,
    "record_id_concat_keep_empty": q_record_id_concat_keep_empty,
    "required_columns_filter": q_required_columns_filter,
    "latest_per_key": q_latest_per_key,
    "high_water_mark": q_high_water_mark,
    "incremental_filter": q_incremental_filter,
    "align_to_contract": q_align_to_contract,
    "ingestion_failed_casts": q_ingestion_failed_casts,
    "rescued_values": q_rescued_values,
    "streamed_latest_purchase_order": q_streamed_latest_purchase_order,
    "distinct_keys": q_distinct_keys,
    "ref_check_mandatory": q_ref_check_mandatory,
    "ref_check_optional": q_ref_check_optional,
    "reference_rejects": q_reference_rejects,
    "published_audit": q_published_audit,
    "reference_then_and_now": q_reference_then_and_now,
    "upsert_two_batches": q_upsert_two_batches,
    "upsert_preserve_created": q_upsert_preserve_created,
    "upsert_null_key_safe": q_upsert_null_key_safe,
    "upsert_null_key_plain": q_upsert_null_key_plain,
    "insert_only": q_insert_only,
    "contract_conformance": q_contract_conformance,
    "sql_preview": q_sql_preview,
    "published_trusted_shipment": q_published_trusted_shipment,
    "published_bucketed_trusted_shipment": q_published_bucketed_trusted_shipment,
    "incremental_publish_purchase_order": q_incremental_publish_purchase_order,
    "landing_to_trusted": q_landing_to_trusted,
    "landing_to_trusted_inventory": q_landing_to_trusted_inventory,
    "incremental_trusted_shipment": q_incremental_trusted_shipment,
    "waiting_trusted_shipment": q_waiting_trusted_shipment,
    "waiting_rows": q_waiting_rows,
    "rejected_rows": q_rejected_rows,
    **{f"foundation_{d}": _layer_query("foundation", d) for d in DATASETS},
    **{f"trusted_{d}": _layer_query("trusted", d) for d in DATASETS},
}
