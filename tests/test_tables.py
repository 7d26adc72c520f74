import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stratum.contracts import contract
from stratum.operators.columns import assert_conforms, null_violations, schema_diff
from stratum.operators.watermark import high_water_mark, incremental_after, incremental_filter
from stratum.sources.tables import SnapshotTable


def _material(spark, rows):
    c = contract("material", "trusted")
    return spark.createDataFrame(rows, c.schema())


T = dt.datetime(2024, 1, 1)


def test_create_publish_read_and_failed_attempt(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir, contract("material", "trusted"))
    assert t.read().count() == 0 and t.current_version() is None
    t.create_if_absent()
    assert t.current_version() == 0
    v1 = t.publish(_material(spark, [("M1", "n", None, None, None, "SAP", T, T)]))
    assert v1 == 1 and t.read().count() == 1
    # a crashed write: folder without commit marker is ignored, next attempt gets a new number
    os.makedirs(f"{t.path}/v=00000002")
    assert t.current_version() == 1 and t.read().count() == 1
    v3 = t.publish(t.read().unionByName(_material(spark, [("M2", "n", None, None, None, "SAP", T, T)])))
    assert v3 == 3 and t.read().count() == 2 and t.read(1).count() == 1
    assert t.retain(1) == [0, 1, 2]
    assert t.current_version() == 3


def test_publish_rejects_null_in_required_column(spark, tmp_dir):
    t = SnapshotTable(spark, tmp_dir, contract("material", "trusted"))
    bad = spark.createDataFrame([(None, "n", None, None, None, "SAP", T, T)],
                                "material_id string, material_name string, material_type string, "
                                "unit_of_measure string, product_group string, source_system string, "
                                "record_created_timestamp timestamp, record_updated_timestamp timestamp")
    with pytest.raises(ValueError, match="NOT NULL"):
        t.publish(bad)
    assert t.current_version() is None


def test_partitioned_table_roundtrip(spark, tmp_dir):
    c = contract("inventory", "trusted")
    t = SnapshotTable(spark, tmp_dir, c, ("inventory_snapshot_date",))
    row = (dt.date(2024, 1, 5), "M", "P", None, None, None, None, "EA", "SAP", T, T)
    t.publish(spark.createDataFrame([row], c.schema()))
    got = t.read()
    assert got.columns == c.names and tuple(got.first()) == row


def test_conformance(spark):
    c = contract("material", "foundation")
    df = spark.createDataFrame([("M1", 1)], "material_id string, extra int")
    problems = {(n, p) for n, p, _ in schema_diff(df, c)}
    assert ("extra", "extra") in problems and ("source_system", "missing") in problems
    df2 = spark.createDataFrame([(None,), ("x",)], "material_id string")
    assert {(r.column_name, r.null_count) for r in null_violations(df2, c).collect()} == {("material_id", 1)}
    with pytest.raises(ValueError):
        assert_conforms(df2, c)


def test_high_water_mark_and_incremental(spark):
    raw = spark.createDataFrame([(1, T), (2, T + dt.timedelta(days=1))], "id int, ingestion_timestamp timestamp")
    empty = spark.createDataFrame([], "source_ingestion_timestamp timestamp")
    assert high_water_mark(empty, "source_ingestion_timestamp") is None
    assert incremental_filter(raw, None).count() == 2  # null mark: full read
    assert [r.id for r in incremental_filter(raw, T).collect()] == [2]  # row at the mark excluded
    target = spark.createDataFrame([(T,)], "source_ingestion_timestamp timestamp")
    assert [r.id for r in incremental_after(raw, target, "source_ingestion_timestamp").collect()] == [2]
    assert incremental_after(raw, empty, "source_ingestion_timestamp").count() == 2


def test_incremental_filter_pushed_to_scan(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    spark.range(10).select(F.col("id"), (F.lit(T) + F.make_interval(days=F.col("id").cast("int")))
                           .alias("ingestion_timestamp")).write.parquet(path)
    plan = incremental_filter(spark.read.parquet(path), T)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ingestion_timestamp" in plan


def test_insert_only_publish_appends_new_keys(spark, tmp_dir):
    from stratum.operators.merge import new_rows
    t = SnapshotTable(spark, tmp_dir, contract("material", "trusted"))
    t.publish(_material(spark, [("M1", "old", None, None, None, "SAP", T, T)]))
    src = _material(spark, [("M1", "changed", None, None, None, "SAP", T, T),
                            ("M2", "new", None, None, None, "SAP", T, T)])
    t.append(new_rows(t.read(), src, ["source_system", "material_id"]))
    assert sorted((r.material_id, r.material_name) for r in t.read().collect()) == [("M1", "old"), ("M2", "new")]


def test_high_water_filter_can_use_file_statistics(spark, tmp_dir):
    from pyspark.sql import functions as F

    from stratum.operators.watermark import incremental_after
    for i in range(10):
        (spark.range(100).withColumn("ts", (F.lit(f"2024-01-{i + 1:02d}").cast("timestamp"))).coalesce(1)
         .write.option("compression", "none").mode("append").parquet(tmp_dir + "/raw"))
    raw = spark.read.parquet(tmp_dir + "/raw")
    target = spark.createDataFrame([(None,)], "m timestamp")
    assert incremental_after(raw, target, "m", "ts").count() == 1000
    mark = spark.sql("SELECT TIMESTAMP '2024-01-08' AS m")
    new = incremental_after(raw, mark, "m", "ts")
    assert new.count() == 200
    # the files carry statistics that the comparison can use, and the scan holds the comparison
    import glob

    import pyarrow.parquet as pq
    for f in glob.glob(tmp_dir + "/raw/*.parquet"):
        column = pq.ParquetFile(f).metadata.row_group(0).column(1)
        assert column.physical_type == "INT64" and column.statistics.has_min_max
    text = new._jdf.queryExecution().explainString(new._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert "DataFilters: [isnotnull(ts" in text and " > coalesce(" in text.split("DataFilters:")[1]
