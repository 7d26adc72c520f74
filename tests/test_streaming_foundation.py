"""Incremental Foundation over streamed Raw equals the batch Foundation over all Raw."""

import os

from pyspark.sql import functions as F

from stratum.contracts import contract
from stratum.plans.foundation import foundation
from stratum.plans.specs import spec
from stratum.sources.tables import ChangeTable, SnapshotTable
from stratum.streaming.foundation import foundation_stream, latest_rows, latest_stream
from stratum.streaming.ingest import IngestionConfig, ingest_raw, raw_paths, read_raw

def TS_():
    return F.lit("2024-06-30").cast("timestamp")


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _land_and_ingest(spark, landing, root, name, fname, text):
    _write(landing, fname, text)
    data, ckpt = raw_paths(root, name)
    ingest_raw(spark, IngestionConfig(name, landing, source_system="sap"), data, ckpt)
    return data


def _same(a, b):
    cols = a.columns
    return a.exceptAll(b.select(*cols)).count() == 0 and b.select(*cols).exceptAll(a).count() == 0


def test_material_two_deliveries(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    head = "material_id,material_name,material_type,unit_of_measure,product_group\n"
    s = spec("material")
    table = SnapshotTable(spark, root, contract("material", "foundation"))
    ckpt = f"{root}/_fnd_ckpt/material"
    data = _land_and_ingest(spark, landing, root, "material", "a.csv", head + " m1 ,one,t,ea,g\nm2,two,t,ea,g\nN/A,x,t,ea,g\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    v1 = table.current_version()
    _land_and_ingest(spark, landing, root, "material", "b.csv", head + "m1,ONE-new,t,ea,g\nm3,three,t,ea,g\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    assert table.current_version() > v1
    rows = {r.material_id: r.material_name for r in table.read().collect()}
    assert rows == {"M1": "ONE-new", "M2": "two", "M3": "three"}
    assert _same(table.read(), foundation(s, read_raw(spark, root, "material"), TS_()))
    foundation_stream(spark, s, data, table, ckpt, TS_())  # nothing new: no new version
    assert table.current_version() == v1 + 1


def test_inventory_partitioned_two_deliveries(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/inventory", f"{tmp_dir}/lake"
    head = "inventory_snapshot_date,material_id,plant_id,storage_location,available_quantity\n"
    s = spec("inventory")
    table = ChangeTable(spark, root, contract("inventory", "foundation"), s.keys, s.nullable_keys(), s.partition_by)
    ckpt = f"{root}/_fnd_ckpt/inventory"
    data = _land_and_ingest(spark, landing, root, "inventory", "a.csv",
                            head + "2024-01-01,m1,p1,,1\n2024-01-02,m1,p1,a,2\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    _land_and_ingest(spark, landing, root, "inventory", "b.csv", head + "2024-01-01,m1,p1,,5\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    got = {(r.inventory_snapshot_date.day, r.storage_location): float(r.available_quantity)
           for r in table.read().collect()}
    assert got == {(1, None): 5.0, (2, "A"): 2.0}
    assert _same(table.read(), foundation(s, read_raw(spark, root, "inventory"), TS_()))


def test_material_bucketed_two_deliveries(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    head = "material_id,material_name,material_type,unit_of_measure,product_group\n"
    s = spec("material")
    table = ChangeTable(spark, root, contract("material", "foundation"), s.keys, buckets=4)
    ckpt = f"{root}/_fnd_ckpt/material"
    data = _land_and_ingest(spark, landing, root, "material", "a.csv", head + " m1 ,one,t,ea,g\nm2,two,t,ea,g\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    _land_and_ingest(spark, landing, root, "material", "b.csv", head + "m1,ONE-new,t,ea,g\nm3,three,t,ea,g\n")
    foundation_stream(spark, s, data, table, ckpt, TS_())
    rows = {r.material_id: r.material_name for r in table.read().collect()}
    assert rows == {"M1": "ONE-new", "M2": "two", "M3": "three"}
    assert _same(table.read(), foundation(s, read_raw(spark, root, "material"), TS_()))


def test_a_late_file_loses_to_a_newer_published_row(spark, tmp_dir):
    s, c = spec("inventory"), contract("inventory", "raw")
    table = ChangeTable(spark, tmp_dir, contract("inventory", "foundation"), s.keys, s.nullable_keys(), s.partition_by)

    def arrive(*rows):
        cells = [{"inventory_snapshot_date": "2024-01-01", "material_id": m, "plant_id": "p", "storage_location": loc, "available_quantity": n, "source_system": "sap",
                  "source_file": f, "ingestion_timestamp": f"2024-01-0{day} 00:00:00", "ingestion_date": f"2024-01-0{day}"} for m, loc, n, day, f in rows]
        fields = [*c.schema().fields]
        df = spark.createDataFrame([tuple(None if x.get(f.name) is None else str(x[f.name]) for f in fields) + (x["ingestion_date"],) for x in cells], ", ".join(f"{f.name} string" for f in fields) + ", ingestion_date string")
        df.select(*[df[f.name].cast(f.dataType) for f in fields], df.ingestion_date.cast("date")).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/raw")
        query = latest_stream(spark, s, f"{tmp_dir}/raw", table, f"{tmp_dir}/ckpt", TS_())
        assert query.exception() is None
        return {(r.material_id, r.storage_location): int(r.available_quantity) for r in table.read().collect()}

    assert arrive(("m1", None, 5, 3, "b"), ("m2", "a", 1, 1, "a"), ("", "a", 9, 9, "a")) == {("M1", None): 5, ("M2", "A"): 1}
    # a new run of the query: the state is that of the checkpoint; older rows arrive late, one ties and has the greater file
    assert arrive((" M1", None, 4, 2, "z"), ("m2", "a", 7, 1, "b"), ("m3", None, 1, 1, "a")) == {("M1", None): 5, ("M2", "A"): 7, ("M3", None): 1}
    assert arrive(("m1", None, 6, 4, "a"), ("m2", "a", 2, 1, "a")) == {("M1", None): 6, ("M2", "A"): 7, ("M3", None): 1}
    raw = spark.read.parquet(f"{tmp_dir}/raw")
    assert _same(table.read(), foundation(s, raw, TS_()))
    assert latest_rows(s, raw).count() == 3 and latest_rows(s, raw.limit(0)).count() == 0


def test_the_state_of_the_latest_rows_lies_in_rocksdb(spark, tmp_dir):
    """A state as large as the table must not be held in the executors' memory."""
    import datetime as dt
    import glob
    from dataclasses import replace

    from stratum.operators.columns import align_to_contract
    from stratum.plans import layered
    from stratum.streaming.foundation import STATE_CONF
    from stratum.streaming.ingest import DATE_COLUMN

    s, before = spec("purchase_order"), {k: spark.conf.get(k, None) for k in STATE_CONF}
    raw = spark.createDataFrame([(f" po-{i % 40}", "1", f"m{i}", "s", "p", dt.datetime(2024, 1, 1 + i % 3)) for i in range(90)],
                                "purchase_order_id string, purchase_order_line string, material_id string, supplier_id string, plant_id string, ingestion_timestamp timestamp")
    raw = align_to_contract(raw.withColumns({"source_system": F.lit("sap"), "source_file": F.lit("f")}), contract("purchase_order", "raw"))
    raw.withColumn(DATE_COLUMN, F.to_date("ingestion_timestamp")).write.parquet(f"{tmp_dir}/raw")
    table = layered.tables(spark, tmp_dir, "foundation", 2)["purchase_order"]
    latest_stream(spark, s, f"{tmp_dir}/raw", table, f"{tmp_dir}/ckpt", F.lit(dt.datetime(2024, 6, 1)))
    stored = glob.glob(f"{tmp_dir}/ckpt/state/0/*/*")
    assert [f for f in stored if f.endswith((".changelog", ".zip"))] and not [f for f in stored if f.endswith((".delta", ".snapshot"))]
    assert {k: spark.conf.get(k, None) for k in STATE_CONF} == before
    plan = latest_rows(s, raw)._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan  # which would hold the columns of the order twice
    expected = foundation(replace(s, incremental=False), raw, F.lit(dt.datetime(2024, 6, 1)))
    assert table.read().count() == 40 and sorted(table.read().collect()) == sorted(expected.collect())


def test_available_now_and_running_queries_go_on_from_each_other(spark, tmp_dir):
    """Large micro-batches store files of RocksDB alone, small ones what changed; the state is the same."""
    import glob
    from dataclasses import replace

    s, c = spec("supplier"), contract("supplier", "raw")
    table = ChangeTable(spark, tmp_dir, contract("supplier", "foundation"), s.keys, buckets=2)
    for n, continuous in enumerate((False, True, False), 1):
        rows = spark.createDataFrame([(f"s{i}", f"name {n}", "sap", f"f{n}", f"2024-01-0{n} 00:00:00") for i in range(n, 3 * n)],
                                     "supplier_id string, supplier_name string, source_system string, source_file string, ingestion_timestamp string")
        rows = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in c.schema().fields])
        rows.withColumn("ingestion_date", F.to_date("ingestion_timestamp")).write.mode("append").parquet(f"{tmp_dir}/raw")
        query = latest_stream(spark, s, f"{tmp_dir}/raw", table, f"{tmp_dir}/ckpt", TS_(), continuous=continuous)
        if continuous:
            try:
                query.processAllAvailable()
            finally:
                query.stop()
        changelogs = glob.glob(f"{tmp_dir}/ckpt/state/0/*/*.changelog")
        assert bool(changelogs) == (n > 1) and glob.glob(f"{tmp_dir}/ckpt/state/0/*/*.zip")
    assert _same(table.read(), foundation(replace(s, incremental=False), spark.read.parquet(f"{tmp_dir}/raw"), TS_()))
