"""Pipelines against the DuckDB oracle, layered publishing, and plan properties."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SF0001
from stratum.plans import layered
from oracle.queries import SQL
from stratum.plans.queries import QUERIES, trusted_all
from stratum.plans.specs import spec
from stratum.plans.trusted import trusted
from stratum.sources import fixtures
from tools.check_oracle import digest, duck

NAMES = sorted(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sp = queries()[name](spark, SF0001).toPandas()
    dd = con.execute(oracle_sql()[name]).df()
    assert digest(sp) == digest(dd)


def test_every_query_has_oracle():
    assert set(QUERIES) | {"ingest_available_now"} == set(SQL) <= set(queries()) & set(oracle_sql())


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "shipment_id" in df.columns


def test_no_python_in_any_plan(spark):
    writes = ("ingest_available_now", "published_trusted_shipment", "published_bucketed_trusted_shipment",
              "incremental_publish_purchase_order", "landing_to_trusted", "incremental_trusted_shipment", "ingestion_failed_casts",
              "waiting_trusted_shipment", "waiting_rows", "landing_to_trusted_inventory",
              "rescued_values", "streamed_latest_purchase_order")
    for name in NAMES:
        if name in writes:  # these run jobs to build their result; same operators as the others
            continue
        plan = queries()[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        for marker in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert marker not in plan, (name, marker)


def test_foundation_plans_use_partial_window_group_limit(spark):
    for d in ("material", "purchase_order", "shipment", "inventory"):
        plan = QUERIES[f"foundation_{d}"](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan and "Partial" in plan, d


def test_layered_publish_equals_in_memory_and_is_idempotent(spark, tmp_dir):
    raw = fixtures.raw_all(spark, SF0001)
    run1 = F.lit("2024-06-30").cast("timestamp")
    layered.run_layered(spark, raw, tmp_dir, run1)
    published = layered.read_layer(spark, tmp_dir, "trusted")
    expected = trusted_all(spark, SF0001, "2024-06-30 00:00:00")
    for d, exp in expected.items():
        got = published[d].select(*exp.columns)
        assert exp.exceptAll(got).count() == 0 and got.exceptAll(exp).count() == 0, d
    # the source of a Trusted shipment publish reads Foundation shipments once, with few exchanges
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        source = trusted(spec("shipment"), layered.tables(spark, tmp_dir, "foundation")["shipment"].read(), published)
        plan = source._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum("FileScan" in line and "shipment_id" in line for line in plan.splitlines()) == 1
    assert plan.count("Exchange hashpartitioning") <= 8
    layered.run_layered(spark, raw, tmp_dir, F.lit("2024-07-01").cast("timestamp"), keep_versions=1)
    again = layered.read_layer(spark, tmp_dir, "trusted")
    kept = layered.tables(spark, tmp_dir, "trusted")["material"]
    assert len([f for f in kept._folders() if f[1] == "base"]) == 1
    for d, exp in expected.items():
        a = again[d].drop("record_updated_timestamp")
        assert a.exceptAll(exp.drop("record_updated_timestamp")).count() == 0, d  # created time preserved


def test_bucketed_sinks_publish_the_same_tables(spark, tmp_dir):
    """Bucketed tables, filled by two deliveries (split by ingestion time),
    publish the same Trusted layer as the in-memory run over everything."""
    raw = fixtures.raw_all(spark, SF0001)
    cut = F.lit("1998-01-01").cast("timestamp")
    ts = F.lit("2024-06-30").cast("timestamp")
    part1 = {d: df.filter(F.col("ingestion_timestamp") <= cut) for d, df in raw.items()}
    layered.run_layered(spark, part1, tmp_dir, ts, buckets=4)
    layered.run_layered(spark, raw, tmp_dir, ts, buckets=4)
    shipments = layered.tables(spark, tmp_dir, "trusted", buckets=4)["shipment"]
    assert shipments.bucketed and shipments._folders()[0][2].endswith("v=00000000.4")
    published = layered.read_layer(spark, tmp_dir, "trusted", buckets=4)
    expected = trusted_all(spark, SF0001, "2024-06-30 00:00:00")
    for d, exp in expected.items():
        got = published[d].select(*exp.columns)
        assert exp.exceptAll(got).count() == 0 and got.exceptAll(exp).count() == 0, d


def test_incremental_runs_equal_full_run(spark, tmp_dir):
    """Purchase orders delivered in two parts (by ingestion time) publish the same
    Foundation table as one run over everything."""
    raw = fixtures.raw_all(spark, SF0001)
    cut = F.lit("1998-01-01").cast("timestamp")
    ts = F.lit("2024-06-30").cast("timestamp")
    part1 = dict(raw, purchase_order=raw["purchase_order"].filter(F.col("ingestion_timestamp") <= cut))
    layered.run_layered(spark, part1, f"{tmp_dir}/inc", ts, datasets=("purchase_order",))
    layered.run_layered(spark, raw, f"{tmp_dir}/inc", ts, datasets=("purchase_order",))
    layered.run_layered(spark, raw, f"{tmp_dir}/full", ts, datasets=("purchase_order",))
    a = layered.read_layer(spark, f"{tmp_dir}/inc", "foundation")["purchase_order"]
    b = layered.read_layer(spark, f"{tmp_dir}/full", "foundation")["purchase_order"]
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_parity_mode_overwrites_created_for_shipment(spark, tmp_dir):
    from stratum.plans.specs import parity
    assert parity(spec("shipment")).preserve_on_update == ()
    assert parity(spec("material")).preserve_on_update == spec("material").preserve_on_update
    raw = fixtures.raw_all(spark, SF0001)
    for ts in ("2024-06-30", "2024-07-01"):
        layered.run_layered(spark, raw, tmp_dir, F.lit(ts).cast("timestamp"), parity_mode=True,
                            datasets=("shipment",))
    f = layered.read_layer(spark, tmp_dir, "foundation")["shipment"]
    assert {r[0].day for r in f.select("record_created_timestamp").distinct().collect()} == {1}


def test_empty_incremental_delivery_publishes_nothing(spark, tmp_dir):
    raw = fixtures.raw_all(spark, SF0001)
    ts = F.lit("2024-06-30").cast("timestamp")
    v1 = layered.run_layered(spark, raw, tmp_dir, ts, datasets=("purchase_order",))
    v2 = layered.run_layered(spark, raw, tmp_dir, ts, datasets=("purchase_order",))
    assert v1["foundation"]["purchase_order"] == 0 and v2["foundation"]["purchase_order"] is None


def test_trusted_from_due_and_waiting_rows_equals_full_runs(spark, tmp_dir, monkeypatch):
    """Three deliveries at three times: Trusted from due rows, and from changed and freed rows,
    equals Trusted from all of Foundation; a waiting row is only looked at when it may be free."""
    from stratum.plans.queries import three_deliveries, ts
    looked_at, judge = [], layered.trs.judged_rows

    def counting(s, rows, refs):
        if s.name == "shipment":
            looked_at.append(rows.count())
        return judge(s, rows, refs)

    monkeypatch.setattr(layered.trs, "judged_rows", counting)
    held = {}
    for run, rows in three_deliveries(spark, SF0001):
        for take in (layered.ALL, layered.DUE, layered.WAITING):
            layered.run_layered(spark, rows, f"{tmp_dir}/{take}", ts(run), datasets=tuple(rows), take=take, buckets=2)
        held[run] = layered.waiting_table(spark, f"{tmp_dir}/waiting", spec("shipment")).read().count()
    full, due, waiting = (layered.read_layer(spark, f"{tmp_dir}/{m}", "trusted") for m in (layered.ALL, layered.DUE, layered.WAITING))
    for d in ("material", "supplier", "plant", "purchase_order", "shipment"):
        assert full[d].count() == due[d].count() == waiting[d].count() > 0, d
        assert full[d].exceptAll(due[d]).count() == 0 and full[d].exceptAll(waiting[d]).count() == 0, d
    # rows of every run are there, and some came in at a later run than their Foundation row
    assert due["shipment"].select("record_updated_timestamp").distinct().count() == 3
    fnd = layered.read_layer(spark, f"{tmp_dir}/due", "foundation")
    left = layered.due_keys(spec("shipment"), fnd["shipment"], due["shipment"])
    assert 0 < left.count() < fnd["shipment"].count()
    # the last run looked at its own rows and at some of those that waited, not at Foundation
    new = layered.tables(spark, f"{tmp_dir}/waiting", "foundation")["shipment"]
    last = held[ts_name(2)]
    assert len(looked_at) == 3 and last > 0 and looked_at[2] < 0.75 * new.read().count()
    # a run without a delivery looks at nothing and changes nothing
    empty = {d: df.limit(0) for d, df in rows.items()}
    layered.run_layered(spark, empty, f"{tmp_dir}/waiting", ts("2024-08-01 00:00:00"), datasets=tuple(rows), take=layered.WAITING, buckets=2)
    assert looked_at[3] == 0 and layered.waiting_table(spark, f"{tmp_dir}/waiting", spec("shipment")).read().count() == last
    again = layered.read_layer(spark, f"{tmp_dir}/waiting", "trusted")["shipment"]
    assert again.exceptAll(full["shipment"]).count() == 0 and again.count() == full["shipment"].count()
    with pytest.raises(ValueError, match="take"):
        layered.run_layered(spark, empty, f"{tmp_dir}/waiting", datasets=(), take="some")


def ts_name(i):
    from stratum.plans import queries as q
    return (q.RUN_TS_0, q.RUN_TS_1, q.RUN_TS)[i]


def test_a_run_that_stops_before_its_progress_repeats_the_same_rows(spark, tmp_dir, monkeypatch):
    from stratum.plans.queries import three_deliveries, ts
    (run1, rows1), (run2, rows2), _ = three_deliveries(spark, SF0001)
    names = tuple(rows1)
    for root in ("a", "b"):
        layered.run_layered(spark, rows1, f"{tmp_dir}/{root}", ts(run1), datasets=names, take=layered.WAITING, buckets=2)
    layered.run_layered(spark, rows2, f"{tmp_dir}/a", ts(run2), datasets=names, take=layered.WAITING, buckets=2)
    publish = layered.SnapshotTable.publish

    def dies(self, df, check=True):
        if self.contract.name == "progress.purchase_order":
            raise RuntimeError("the driver is gone")
        return publish(self, df, check)

    monkeypatch.setattr(layered.SnapshotTable, "publish", dies)
    with pytest.raises(RuntimeError):
        layered.run_layered(spark, rows2, f"{tmp_dir}/b", ts(run2), datasets=names, take=layered.WAITING, buckets=2)
    monkeypatch.setattr(layered.SnapshotTable, "publish", publish)
    layered.run_layered(spark, {d: df.limit(0) for d, df in rows2.items()}, f"{tmp_dir}/b", ts(run2), datasets=names, take=layered.WAITING, buckets=2)
    a, b = (layered.read_layer(spark, f"{tmp_dir}/{r}", "trusted") for r in ("a", "b"))
    for d in names:
        assert a[d].exceptAll(b[d]).count() == 0 == b[d].exceptAll(a[d]).count(), d
    for d in ("purchase_order", "shipment"):
        x, y = (layered.waiting_table(spark, f"{tmp_dir}/{r}", spec(d)).read() for r in ("a", "b"))
        assert x.exceptAll(y).count() == 0 == y.exceptAll(x).count()


def test_due_keys_of_null_and_equal_times(spark):
    s = spec("inventory")
    cols = "source_system string, inventory_snapshot_date date, material_id string, plant_id string, storage_location string, record_updated_timestamp timestamp"
    import datetime as dt
    day, t1, t2 = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    fnd = [("S", day, "M1", "P", None, t1), ("S", day, "M2", "P", "L", t1), ("S", day, "M3", "P", None, t2), ("S", day, "M4", "P", None, t2)]
    held = [("S", day, "M1", "P", None, t1), ("S", day, "M3", "P", None, t1), ("S", day, "M4", "P", None, t2)]
    f, t = spark.createDataFrame(fnd, cols), spark.createDataFrame(held, cols)
    # M1 is held as it is; M2 is not held; M3 has changed; M4 has the latest published time
    assert sorted(r.material_id for r in layered.due_keys(s, f, t).collect()) == ["M2", "M3", "M4"]
    assert sorted(r.material_id for r in layered.due_keys(s, f, t.limit(0)).collect()) == ["M1", "M2", "M3", "M4"]
    assert sorted(r.material_id for r in layered.due_keys(s, f, t, null_safe=False).collect()) == ["M1", "M2", "M3", "M4"]
