"""Landing CSV files -> streaming Raw ingestion (two deliveries) -> layered
publishing -> Trusted; checked by invariants of the published tables."""

from pyspark.sql import functions as F

from conftest import SF0001
from stratum.contracts import payload_columns
from stratum.plans import layered
from stratum.sources import fixtures
from stratum.streaming.ingest import default_configs, read_raw, run_raw_ingestion


def _land(raw, landing, name, delivery):
    cols = payload_columns(name)
    (raw.select(*[F.col(c).cast("string") for c in cols])
        .write.mode("overwrite").option("header", True).csv(f"{landing}/_staging/{name}/{delivery}"))


def test_files_to_trusted(spark, tmp_dir):
    landing, lake = f"{tmp_dir}/landing", f"{tmp_dir}/lake"
    raws = fixtures.raw_all(spark, SF0001)
    names = list(raws)
    # delivery 1: first versions; delivery 2: the second material versions (a later file)
    for name, df in raws.items():
        first = df.filter(F.col("ingestion_batch_id") == "fixture-1")
        _land(first, landing, name, "d1")
    import glob
    import os
    import shutil
    for name in names:  # move finished part files into the watched folder (as a landing process would)
        os.makedirs(f"{landing}/{name}", exist_ok=True)
        for f in glob.glob(f"{landing}/_staging/{name}/d1/part-*.csv"):
            shutil.copy(f, f"{landing}/{name}/d1-{os.path.basename(f)}")
    cfgs = default_configs(landing)
    run_raw_ingestion(spark, cfgs, "all", lake)
    layered.run_layered(spark, {n: read_raw(spark, lake, n) for n in names}, lake)

    _land(raws["material"].filter(F.col("ingestion_batch_id") == "fixture-2"), landing, "material", "d2")
    for f in glob.glob(f"{landing}/_staging/material/d2/part-*.csv"):
        shutil.copy(f, f"{landing}/material/d2-{os.path.basename(f)}")
    run_raw_ingestion(spark, cfgs, "material", lake)
    layered.run_layered(spark, {n: read_raw(spark, lake, n) for n in names}, lake)

    t = layered.read_layer(spark, lake, "trusted")
    f = layered.read_layer(spark, lake, "foundation")

    # the incremental form over the same Raw tables publishes the same Trusted rows
    inc = f"{tmp_dir}/lake_inc"  # same committed Raw files, fresh Foundation/Trusted tables
    layered.run_layered_incremental(spark, inc, raw_root=lake)
    ti = layered.read_layer(spark, inc, "trusted")
    for n in names:
        cols = [c for c in t[n].columns if not c.startswith("record_")]
        assert ti[n].select(*cols).exceptAll(t[n].select(*cols)).count() == 0, n
        assert t[n].select(*cols).exceptAll(ti[n].select(*cols)).count() == 0, n
    for name in names:
        keys = list(layered.spec(name).keys)
        assert t[name].count() > 0, name
        assert t[name].groupBy(*keys).count().filter("count > 1").count() == 0, name  # unique keys
        a, b = t[name].alias("a"), f[name].select(*keys).alias("b")
        cond = [a[k].eqNullSafe(b[k]) for k in keys]  # storage_location may be null
        assert a.join(b, cond, "left_anti").count() == 0, name  # subset of Foundation
    # references of published facts exist in published masters
    for fact, ref, idc in [("purchase_order", "material", "material_id"), ("shipment", "supplier", "supplier_id"),
                           ("inventory", "plant", "plant_id")]:
        assert t[fact].join(t[ref], ["source_system", idc], "left_anti").count() == 0
    # the second delivery's material versions won
    v2 = t["material"].filter(F.col("material_name").endswith(" v2")).count()
    assert v2 == raws["material"].filter("ingestion_batch_id = 'fixture-2' AND material_name <> 'NULL' "
                                         "AND trim(material_id) NOT IN ('', 'N/A')").count() > 0
