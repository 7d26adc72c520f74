import decimal
import os

import pytest

from stratum.contracts import contract
from stratum.operators.columns import cast_failures
from stratum.streaming.ingest import (IngestionConfig, await_any, default_configs, failed_casts, ingest_raw, raw_paths, read_raw, rescued_counts, rescued_values,
                                      run_raw_ingestion, select_datasets)

HEADER = "material_id,material_name,material_type,unit_of_measure,product_group"


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def _cfg(landing, name="material", **kw):
    return IngestionConfig(name, landing, source_system="sap", **kw)


def _ingest(spark, cfg, root):
    data, ckpt = raw_paths(root, cfg.name)
    ingest_raw(spark, cfg, data, ckpt)
    return read_raw(spark, root, cfg.name)


def test_two_files_rerun_and_new_file(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", f"{HEADER}\nM1,n1,t,ea,g\nM2,n2,t,ea,g\n")
    _write(landing, "b.csv", f"{HEADER}\nM3,n3,t,ea,g\n")
    cfg = _cfg(landing)
    df = _ingest(spark, cfg, root)
    rows = df.collect()
    assert sorted(r.material_id for r in rows) == ["M1", "M2", "M3"]
    assert len({r.ingestion_batch_id for r in rows}) == 1
    assert {r.source_system for r in rows} == {"sap"}
    assert all(r.source_file.endswith((".csv")) for r in rows)
    assert _ingest(spark, cfg, root).count() == 3  # rerun: nothing new
    _write(landing, "c.csv", f"{HEADER}\nM4,n4,t,ea,g\n")
    rows = _ingest(spark, cfg, root).collect()
    assert sorted(r.material_id for r in rows) == ["M1", "M2", "M3", "M4"]
    assert len({r.ingestion_batch_id for r in rows}) == 2


def test_reordered_extra_missing_columns_bind_by_name(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", "product_group,foo,material_name,material_id\ng,zzz,n1,M1\n")
    r = _ingest(spark, _cfg(landing), root).first()
    assert (r.material_id, r.material_name, r.product_group, r.material_type) == ("M1", "n1", "g", None)
    assert "foo" not in r.asDict()


def test_mixed_layouts_fail(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", "material_id,material_name\nM1,n1\n")
    _write(landing, "b.csv", "material_name,material_id\nn2,M2\n")
    with pytest.raises(Exception):
        _ingest(spark, _cfg(landing), root)


def test_bad_values_become_null_and_decimals_round(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/inventory", f"{tmp_dir}/lake"
    _write(landing, "a.csv",
           "inventory_snapshot_date,material_id,plant_id,available_quantity,source_system\n"
           "2024-01-01,M1,P1,2.55555,xyz\n2024-13-01,M2,P1,abc,xyz\n")
    cfg = IngestionConfig("inventory", landing, source_system="sap")
    rows = {r.material_id: r for r in _ingest(spark, cfg, root).collect()}
    assert rows["M1"].available_quantity == decimal.Decimal("2.5556")
    assert rows["M2"].available_quantity is None and rows["M2"].inventory_snapshot_date is None
    assert {r.source_system for r in rows.values()} == {"sap"}  # payload column replaced


def test_cast_failures_counted(spark):
    df = spark.createDataFrame([("2024-13-01", "abc"), ("2024-01-01", "1.5"), (None, None)],
                               "inventory_snapshot_date string, available_quantity string")
    r = cast_failures(df, contract("inventory", "raw")).first()
    assert (r.inventory_snapshot_date, r.available_quantity) == (1, 1)


def test_strict_mode_fails_on_bad_value(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/inventory", f"{tmp_dir}/lake"
    _write(landing, "a.csv", "inventory_snapshot_date,material_id\n2024-13-01,M1\n")
    cfg = IngestionConfig("inventory", landing, source_system="sap")
    data, ckpt = raw_paths(root, "inventory")
    with pytest.raises(Exception):
        ingest_raw(spark, cfg, data, ckpt, strict=True)


def test_json_and_parquet_sources(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/plant", f"{tmp_dir}/lake"
    _write(landing, "a.json", '{"plant_id": "P1", "plant_name": "x", "extra": 1}\n')
    r = _ingest(spark, IngestionConfig("plant", landing, format="JSON", source_system="sap"), root).first()
    assert (r.plant_id, r.plant_name, r.city) == ("P1", "x", None)
    pq_landing = f"{tmp_dir}/landing/supplier"
    spark.createDataFrame([("S1", "n")], "supplier_id string, supplier_name string").write.parquet(pq_landing)
    r = _ingest(spark, IngestionConfig("supplier", pq_landing, format="parquet", source_system="sap"),
                f"{tmp_dir}/lake2").first()
    assert (r.supplier_id, r.supplier_name) == ("S1", "n")


def test_config_errors(spark, tmp_dir):
    with pytest.raises(ValueError, match="format"):
        IngestionConfig("m", tmp_dir, format="xml", source_system="sap").validated()
    with pytest.raises(ValueError, match="source type"):
        IngestionConfig("m", tmp_dir, source_type="api", source_system="sap").validated()
    with pytest.raises(ValueError, match="load mode"):
        IngestionConfig("m", tmp_dir, load_mode="overwrite", source_system="sap").validated()
    with pytest.raises(ValueError, match="source_system"):
        IngestionConfig("m", tmp_dir).validated()


def test_select_datasets():
    avail = ["material", "plant", "supplier"]
    assert select_datasets("all", avail) == avail
    assert select_datasets(" Plant , material", avail) == ["material", "plant"]
    with pytest.raises(ValueError):
        select_datasets("nope", avail)
    with pytest.raises(ValueError):
        select_datasets(" , ", avail)


def test_run_several_datasets_and_continuous(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    _write(f"{landing}/material", "a.csv", f"{HEADER}\nM1,n1,t,ea,g\n")
    _write(f"{landing}/plant", "a.csv", "plant_id,plant_name\nP1,p\n")
    cfgs = {k: v for k, v in default_configs(landing).items() if k in ("material", "plant")}
    qs = run_raw_ingestion(spark, cfgs, "all", f"{tmp_dir}/lake")
    assert all(not q.isActive for q in qs)
    assert read_raw(spark, f"{tmp_dir}/lake", "plant").count() == 1
    # continuous: stays up until stopped; a new file is picked up
    qs = run_raw_ingestion(spark, cfgs, "material", f"{tmp_dir}/lake", continuous=True, processing_time="1 second")
    try:
        _write(f"{landing}/material", "b.csv", f"{HEADER}\nM2,n2,t,ea,g\n")
        qs[0].processAllAvailable()
        assert qs[0].isActive
        assert await_any(spark, 1) is False  # still running
        assert read_raw(spark, f"{tmp_dir}/lake", "material").count() == 2
    finally:
        for q in qs:
            q.stop()


def test_stream_equals_batch(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", f"{HEADER}\n  m1 ,N/A,t,ea,g\nM2,n2,t,ea,g\n")
    streamed = _ingest(spark, _cfg(landing), root).drop("source_file", "ingestion_batch_id", "ingestion_timestamp")
    batch = spark.read.option("header", True).csv(landing).select(*streamed.columns[:-1])
    assert sorted(map(tuple, streamed.drop("source_system").collect())) == sorted(map(tuple, batch.collect()))


def test_late_correction_wins_by_ingestion_time(spark, tmp_dir):
    """A corrected file that lands later is a new Raw row and wins in Foundation."""
    from pyspark.sql import functions as F
    from stratum.plans.foundation import foundation
    from stratum.plans.specs import spec
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", f"{HEADER}\nm1,old,t,ea,g\n")
    _ingest(spark, _cfg(landing), root)
    _write(landing, "b.csv", f"{HEADER}\n m1 ,new,t,ea,g\n")
    raw = _ingest(spark, _cfg(landing), root)
    assert raw.count() == 2
    out = foundation(spec("material"), raw, F.current_timestamp()).collect()
    assert [(r.material_id, r.material_name) for r in out] == [("M1", "new")]


def test_what_does_not_fit_is_rescued(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/inventory", f"{tmp_dir}/lake"
    _write(landing, "a.csv", "inventory_snapshot_date,material_id,available_quantity,note\n2024-13-01,M1,abc,{a} [b] 'é'\n2024-01-01,M2,def,\n,M3,,\n2024-01-02,M4,1,\n")
    cfg, target = IngestionConfig("inventory", landing, source_system="sap"), contract("inventory", "raw")
    data, ckpt = raw_paths(root, "inventory")
    for _ in range(2):  # no new file, no micro-batch
        ingest_raw(spark, cfg, data, ckpt)
        assert failed_casts(spark, data, target) == {"inventory_snapshot_date": 1, "available_quantity": 2}
    values = {(r.column_name, r.kind, r.value) for r in rescued_values(spark, data, target).collect()}
    assert values == {("inventory_snapshot_date", "cast", "2024-13-01"), ("available_quantity", "cast", "abc"), ("available_quantity", "cast", "def"), ("note", "extra", "{a} [b] 'é'")}
    assert read_raw(spark, root, "inventory").columns == target.names and read_raw(spark, root, "inventory").count() == 4
    # each run's micro-batch has its counts; rows that fit have none
    _write(landing, "b.csv", "inventory_snapshot_date,material_id,available_quantity,note\nx,M5,2,\n2024-01-02,M6,1,\n")
    ingest_raw(spark, cfg, data, ckpt)
    counts = rescued_counts(spark, data, target).collect()
    assert sorted((r.column_name, r.rows) for r in counts) == [("available_quantity", 2), ("inventory_snapshot_date", 1), ("inventory_snapshot_date", 1), ("note", 1)]
    assert len({r.ingestion_timestamp for r in counts}) == 2
    held = spark.read.schema("material_id string, _rescued variant").parquet(data)
    assert {r.material_id for r in held.where("_rescued is null").collect()} == {"M3", "M4", "M6"}
    assert held.where("material_id = 'M2'").selectExpr("variant_get(_rescued, '$.available_quantity', 'string')").first()[0] == "def"


def test_a_batch_that_is_tried_again_is_counted_once(spark, tmp_dir):
    """The commit of a micro-batch is lost after its rows were written: the batch runs again, its files count once."""
    landing, root = f"{tmp_dir}/landing/inventory", f"{tmp_dir}/lake"
    cfg, target = IngestionConfig("inventory", landing, source_system="sap"), contract("inventory", "raw")
    data, ckpt = raw_paths(root, "inventory")
    for name in ("a", "b"):
        _write(landing, f"{name}.csv", f"inventory_snapshot_date,material_id,available_quantity\nbad,{name},1\n")
        ingest_raw(spark, cfg, data, ckpt)
    os.remove(f"{ckpt}/commits/1")
    if os.path.exists(f"{ckpt}/commits/.1.crc"):
        os.remove(f"{ckpt}/commits/.1.crc")
    ingest_raw(spark, cfg, data, ckpt)
    assert failed_casts(spark, data, target) == {"inventory_snapshot_date": 2} and read_raw(spark, root, "inventory").count() == 2


def test_high_water_filter_prunes_folders_of_raw(spark, tmp_dir):
    """On files of the repository's own Raw sink, on the path of the layered run."""
    from pyspark.sql import functions as F
    from stratum.plans import layered
    from test_skew import _nodes
    landing, root = f"{tmp_dir}/landing/purchase_order", f"{tmp_dir}/lake"
    cfg = IngestionConfig("purchase_order", landing, source_system="sap")
    data, ckpt = raw_paths(root, "purchase_order")
    for day in range(1, 7):
        lines = [f"PO{day}-{i},1,M{i},S1,P1" for i in range(10)]
        _write(landing, f"{day}.csv", "\n".join(["purchase_order_id,purchase_order_line,material_id,supplier_id,plant_id", *lines]))
        ingest_raw(spark, cfg, data, ckpt, run_ts=F.lit(f"2024-01-0{day} 23:30:00").cast("timestamp"))
    raw = read_raw(spark, root, "purchase_order", dated=True)
    assert raw.count() == 60 and sorted(os.listdir(data))[:2] == ["_spark_metadata", "ingestion_date=2024-01-01"]
    s, table = layered.spec("purchase_order"), layered.tables(spark, f"{tmp_dir}/out", "foundation")["purchase_order"]
    first = raw.filter("ingestion_timestamp < timestamp'2024-01-05'")
    layered.foundation_step(spark, s, first, table, F.current_timestamp())
    assert table.read().count() == 40  # an empty target reads all of it
    new = layered.incremental_after(raw, table.read(), layered.MARK_COLUMN, s.order_column, layered.DATE_COLUMN)
    assert {r.purchase_order_id[:3] for r in new.collect()} == {"PO5", "PO6"}
    plan = new._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    scan = next(n for n in _nodes(plan) if n.getClass().getSimpleName() == "FileSourceScanExec")
    read = {m: scan.metrics().apply(m).value() for m in ("numPartitions", "numFiles", "numOutputRows")}
    assert read["numPartitions"] == read["numFiles"] == 3 and read["numOutputRows"] <= 30, read  # the mark's own day and the two after it
    layered.foundation_step(spark, s, raw, table, F.current_timestamp())
    assert table.read().count() == 60


def test_raw_of_another_layout_is_refused(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing/material", f"{tmp_dir}/lake"
    _write(landing, "a.csv", f"{HEADER}\nM1,n1,t,ea,g\n")
    data, ckpt = raw_paths(root, "material")
    spark.range(1).write.parquet(data)
    with pytest.raises(ValueError, match="ingestion_date"):
        ingest_raw(spark, _cfg(landing), data, ckpt)


def test_streams_write_their_folder_without_a_sort(spark, tmp_dir, monkeypatch):
    """Rows of a micro-batch have one date: sorting them by it moves every row for nothing."""
    from stratum.streaming import ingest

    before, seen = spark.conf.get(ingest.WRITERS_CONF), []
    real = ingest.add_ingestion_metadata
    monkeypatch.setattr(ingest, "add_ingestion_metadata", lambda *a: seen.append(spark.conf.get(ingest.WRITERS_CONF)) or real(*a))
    _write(f"{tmp_dir}/landing/plant", "a.csv", "plant_id,plant_name\np1,n\n")
    run_raw_ingestion(spark, default_configs(f"{tmp_dir}/landing"), "plant", tmp_dir)
    assert seen == ["2"] and spark.conf.get(ingest.WRITERS_CONF) == before == "0"
    assert read_raw(spark, tmp_dir, "plant").count() == 1
