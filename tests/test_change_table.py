"""Tables that a delivery changes by its own rows: states, bytes written, plans, failures."""

import datetime as dt
import decimal
import glob
import os

import pytest
from pyspark.sql import functions as F

from stratum.contracts import contract
from stratum.operators.merge import upsert
from stratum.plans import layered
from stratum.plans.specs import spec
from stratum.sources.tables import ChangeTable, SnapshotTable

KEYS = ("source_system", "material_id")
T, LATER = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def materials(spark, ids, name, at=T):
    c = contract("material", "trusted")
    rows = spark.createDataFrame([(i,) for i in ids], "i long").select(F.concat(F.lit("M"), "i").alias("material_id"), F.concat(F.lit(name), F.sha2(F.col("i").cast("string"), 256)).alias("material_name"))
    given = {"source_system": F.lit("SAP"), "record_created_timestamp": F.lit(at), "record_updated_timestamp": F.lit(at)}
    return rows.select(*[F.col(f.name) if f.name in rows.columns else given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in c.schema().fields])


def material_table(spark, root, **how):
    return ChangeTable(spark, root, contract("material", "trusted"), KEYS, **{"buckets": 4, **how})


def rows(df):
    return sorted(df.collect())


def size(folder):
    return sum(os.path.getsize(f) for f in glob.glob(f"{folder}/**/*.parquet", recursive=True))


def test_a_delivery_writes_its_own_rows(spark, tmp_dir):
    t = material_table(spark, tmp_dir)
    first, second = materials(spark, range(4000), "a"), materials(spark, [*range(0, 400, 20), *range(9000, 9020)], "b", LATER)
    assert t.read().count() == 0 and t.current_version() is None
    assert t.upsert(first, KEYS) == 0
    base = {f: os.path.getmtime(f) for f in glob.glob(f"{t.path}/base/**/*", recursive=True)}
    assert t.upsert(second, KEYS) == 1
    assert {f: os.path.getmtime(f) for f in glob.glob(f"{t.path}/base/**/*", recursive=True)} == base
    assert size(f"{t.path}/changes/v=00000001") < 0.05 * size(f"{t.path}/base")  # 40 of 4,000 rows
    assert rows(t.read()) == rows(upsert(first, second, list(KEYS)))
    assert rows(t.read(0)) == rows(first) and t.read().columns == contract("material", "trusted").names
    # an empty delivery publishes nothing; what changed since a version is the last state of those keys
    assert t.upsert(second.limit(0), KEYS) is None and t.current_version() == 1
    t.upsert(materials(spark, [0, 1], "c", LATER), KEYS)
    assert sorted(r.material_id for r in t.changes_since(1).collect()) == ["M0", "M1"]
    assert t.changes_since(0).count() == 41 and t.changes_since(2).count() == 0 and t.changes_since(None).count() == t.read().count() == 4020
    assert {r.material_name[0] for r in t.read().where("material_id in ('M0', 'M1')").collect()} == {"c"}


def test_compaction_keeps_the_state_and_open_readers(spark, tmp_dir):
    t = material_table(spark, tmp_dir, share=0.5)
    t.upsert(materials(spark, range(300), "a"))
    t.upsert(materials(spark, range(250, 320), "b", LATER))
    opened, expected = t.read(), rows(t.read())
    wide = ChangeTable(spark, tmp_dir, t.contract, KEYS, buckets=8, share=0.5)  # the next base takes its number
    n = wide.upsert(materials(spark, range(100, 300), "c", LATER))
    assert n == 3 and sorted(os.path.basename(f) for f in glob.glob(f"{t.path}/base/*")) == ["v=00000000.4", "v=00000003.8"]
    assert rows(opened) == expected
    state = rows(upsert(spark.createDataFrame(expected, t.contract.schema()), materials(spark, range(100, 300), "c", LATER), list(KEYS)))
    assert rows(t.read()) == state and t.changed_share() == 0 and t.compact() is None
    assert t.changes_since(1).count() == 200  # a base between adds no rows
    assert t.retain(1) == [0, 1, 2] and rows(t.read()) == state
    assert t.changes_since(1).count() == 320  # those folders are gone: everything


def test_a_delivery_into_a_published_table_is_written_once(spark, tmp_dir, monkeypatch):
    from stratum.sources import tables

    t = material_table(spark, tmp_dir, share=9)
    t.upsert(materials(spark, range(20), "a"))
    monkeypatch.setattr(tables, "delivered", lambda *_: pytest.fail("written to the scratch folder before"))
    kept = ["record_created_timestamp"]
    assert t.upsert(materials(spark, range(10, 30), "b", LATER), KEYS, kept) == 1
    got = {r.material_id: (r.material_name[0], r.record_created_timestamp) for r in t.read().collect()}
    assert len(got) == 30 and got["M5"] == ("a", T) and got["M15"] == ("b", T) and got["M25"] == ("b", LATER)
    # what is refused, or empty, leaves nothing to read and no folder
    twice = materials(spark, [40, 40], "d", LATER)
    with pytest.raises(ValueError, match="duplicate keys"):
        t.upsert(twice)
    assert t.upsert(twice.limit(0)) is None
    assert t.current_version() == 1 and os.listdir(f"{t.path}/changes") == ["v=00000001"] and t.read().count() == 30
    monkeypatch.undo()
    # rows that are written already are not written again, and their share of the folder gives the buckets
    wide = materials(spark, range(4000), "a")
    wide.write.parquet(f"{tmp_dir}/rows")
    monkeypatch.setattr(tables, "delivered", lambda *_: pytest.fail("written again"))
    some = material_table(spark, f"{tmp_dir}/some", bucket_bytes=20_000)
    source = spark.read.schema(wide.schema).parquet(f"{tmp_dir}/rows").where("substring(material_id, -1) = '7'")
    assert some.upsert(source, written=f"{tmp_dir}/rows") == 0 and rows(some.read()) == rows(source)
    assert some.base_buckets() <= 4 + size(f"{tmp_dir}/rows") // 200_000
    assert some.upsert(source.limit(0), written=f"{tmp_dir}/rows") is None


def test_a_table_without_rows_takes_no_part_in_a_join(spark, tmp_dir):
    empty = material_table(spark, tmp_dir)
    for df in (empty.read(), SnapshotTable(spark, f"{tmp_dir}/s", empty.contract).read()):
        assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in empty.contract.schema().fields]
        joined = materials(spark, range(3), "a").join(df, list(KEYS), "left_anti")
        assert "Join" not in plan_of(joined) and joined.count() == 3


def test_another_session_finds_the_buckets(spark, tmp_dir):
    t = material_table(spark, tmp_dir)
    t.upsert(materials(spark, range(50), "a"))
    spark.sql(f"DROP TABLE {t._name(0)}")  # a new session's catalog does not have it
    assert t.read().count() == 50 and spark.table(t._name(0)).where("material_id = 'M7'").count() == 1
    plan = plan_of(t.read().groupBy(*KEYS).count())
    assert "Bucketed: true" in plan and "Exchange" not in plan


def test_failed_attempts_are_not_read(spark, tmp_dir):
    t = material_table(spark, tmp_dir)
    os.makedirs(f"{t.path}/base/v=00000000.4/_temporary")
    assert t.read().count() == 0 and t.upsert(materials(spark, range(9), "a")) == 1
    os.makedirs(f"{t.path}/changes/v=00000002")
    assert t.read().count() == 9 and t.current_version() == 1
    assert t.upsert(materials(spark, range(8, 10), "b", LATER)) in (3, 4) and t.read().count() == 10


def test_refusals(spark, tmp_dir):
    t, good = material_table(spark, tmp_dir), materials(spark, range(5), "a")
    null = good.withColumn("record_created_timestamp", F.lit(None).cast("timestamp"))
    for bad, match in ((null, "NOT NULL"), (good.unionByName(good), "duplicate keys")):
        with pytest.raises(ValueError, match=match):
            t.upsert(bad)
    assert t.read().count() == 0
    t.upsert(good)
    with pytest.raises(ValueError, match="NOT NULL"):
        t.upsert(null)
    with pytest.raises(ValueError, match="key"):
        t.upsert(good, ["material_id"])
    with pytest.raises(ValueError, match="another kind"):
        SnapshotTable(spark, tmp_dir, t.contract).read()
    SnapshotTable(spark, f"{tmp_dir}/s", t.contract).publish(good)
    with pytest.raises(ValueError, match="another kind"):
        material_table(spark, f"{tmp_dir}/s").read()
    with pytest.raises(ValueError):
        ChangeTable(spark, tmp_dir, t.contract, ())
    assert rows(t.read()) == rows(good)
    empty = material_table(spark, f"{tmp_dir}/e")
    empty.create_if_absent()
    assert empty.current_version() == 0 and empty.read().count() == 0


INVENTORY = ("source_system", "inventory_snapshot_date", "material_id", "plant_id", "storage_location")


def inventory(spark, days):
    d = decimal.Decimal
    return spark.createDataFrame([(dt.date(2024, 1, day), "M", "P", storage, d(n), None, None, "EA", "SAP", "r", at, at) for day, storage, n, at in days],
                                 contract("inventory", "foundation").schema())


def test_nullable_keys_and_kept_columns(spark, tmp_dir):
    t = ChangeTable(spark, tmp_dir, contract("inventory", "foundation"), INVENTORY, ("storage_location",), ("inventory_snapshot_date",), share=9)
    keep = ["record_created_timestamp"]
    t.upsert(inventory(spark, [(1, "A", 1, T), (2, None, 2, T)]), INVENTORY, keep)
    t.upsert(inventory(spark, [(2, None, 5, LATER), (3, None, 3, LATER)]), INVENTORY, keep)
    t.upsert(inventory(spark, [(2, None, 6, LATER + dt.timedelta(days=1))]), INVENTORY, keep)
    got = {(r.inventory_snapshot_date.day, r.storage_location): (int(r.available_quantity), r.record_created_timestamp) for r in t.read().collect()}
    assert got == {(1, "A"): (1, T), (2, None): (6, T), (3, None): (3, LATER)}
    one = t.read().where("inventory_snapshot_date = date'2024-01-02'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(inventory_snapshot_date" in plan_of(one)
    before = rows(t.read())
    assert t.compact() == 3 and rows(t.read()) == before
    with pytest.raises(ValueError, match="<=>"):
        t.upsert(inventory(spark, [(1, "A", 1, T)]), INVENTORY, null_safe=False)


def test_plain_equality_inserts_null_keys_again(spark, tmp_dir):
    t = ChangeTable(spark, tmp_dir, contract("inventory", "foundation"), INVENTORY, ("storage_location",), share=9, null_safe=False)
    days = inventory(spark, [(1, "A", 1, T), (2, None, 2, T)])
    state = None
    for _ in range(3):
        t.upsert(days, INVENTORY, null_safe=False)
        state = days if state is None else upsert(state, days, list(INVENTORY), null_safe=False)
    assert t.read().count() == 4 and rows(t.read()) == rows(state)


def plan_of(df):
    df._jdf.queryExecution().executedPlan()
    return df._jdf.queryExecution().executedPlan().toString()


def moved(plan):
    """Scans that stand below a hash exchange."""
    out, open_ = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        open_ = [d for d in open_ if d < depth]
        if "FileScan" in line and open_:
            out.append(line)
        if "Exchange hashpartitioning" in line:
            open_.append(depth)
    return out


def test_joins_on_the_key_do_not_move_published_tables(spark, tmp_dir):
    """Bucketed bases: only changes pass an exchange, in a merge, in ``due_keys`` and in a compaction."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t = material_table(spark, f"{tmp_dir}/t", buckets=16, share=9)
        f = ChangeTable(spark, f"{tmp_dir}/f", t.contract, KEYS, buckets=16, share=9)
        for table, ids in ((t, range(0, 300)), (f, range(0, 320))):
            table.upsert(materials(spark, ids, "a"))
        for table in (t, f):
            table.upsert(materials(spark, range(5, 9), "b", LATER))
        f.upsert(materials(spark, range(8, 12), "c", LATER + dt.timedelta(days=1)))
        due = layered.due_rows(spec("material"), f.read(), t)
        materials(spark, range(3), "x").write.parquet(f"{tmp_dir}/rows")  # else Spark knows that the key is one constant
        for df in (t.read(), f.read(), due, t.looked_up(spark.read.parquet(f"{tmp_dir}/rows"), ["record_created_timestamp"], "_published")):
            plan = plan_of(df)
            scans = moved(plan)
            assert scans and not any("spark_catalog" in line for line in scans), plan
            assert "Bucketed: true" in plan, plan
        assert due.count() == layered.due_rows(spec("material"), f.read(), t.read()).count() > 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # a compaction moves the changes alone, also where they are small: a task for each bucket
    before, expected = f._complete(), rows(f.read())
    plan = plan_of(f._state(before, True))
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and not any("spark_catalog" in line for line in moved(plan))
    n = f.compact()
    assert len(glob.glob(f"{f.path}/base/v={n:08d}.16/*.parquet")) <= 2 * 16 and rows(f.read()) == expected
    assert f.read().where("material_id = 'M9'").count() == 1 and spark.table(f._name(n)).groupBy(*KEYS).count().where("count > 1").count() == 0


def test_buckets_grow_with_the_table(spark, tmp_dir):
    """A task's bucket stays small however large a delivery or the whole table is."""
    t = material_table(spark, tmp_dir, bucket_bytes=20_000)
    first = materials(spark, range(4000), "a")
    t.upsert(first)
    count = t.base_buckets()
    assert count > 10 and size(f"{t.path}/base") / count < 40_000
    more = materials(spark, range(3900, 5500), "b", LATER)
    assert t.upsert(more) == 2 and t.base_buckets() == count  # compacted; not twice as large: no base is dealt anew
    most = materials(spark, range(5000, 14000), "c", LATER)
    assert t.upsert(most) == 4 and t.base_buckets() > 1.5 * count
    state = upsert(upsert(first, more, list(KEYS)), most, list(KEYS))
    assert rows(t.read()) == rows(state)
    small = material_table(spark, f"{tmp_dir}/small")
    small.upsert(materials(spark, range(9), "a"))
    assert small.base_buckets() == 4
    assert layered.dealt_alike(small, t).buckets == t.base_buckets() and layered.dealt_alike(t, small).buckets == 4
