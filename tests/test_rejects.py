"""Rejected rows with their reasons, against the filters and semi joins that drop them."""

from pyspark.sql import functions as F

from conftest import SF0001
from stratum.operators import rejects
from stratum.plans import foundation as fnd
from stratum.plans import trusted as trs
from stratum.plans.queries import foundation_df, trusted_all
from stratum.plans.specs import spec
from stratum.sources import fixtures


def test_reasons_of_rules_and_references(spark):
    df = spark.createDataFrame([(1, "a", "x", None, None), (2, "", "x", "p", "1"), (3, None, None, "q", "1"), (4, "b", "y", "p", None), (5, "b", "x", "p", "1"), (None, "a", "x", "", "")],
                               "id long, name string, plant string, po string, line string")
    plants = spark.createDataFrame([("x",), ("x",), (None,)], "plant string")
    orders = spark.createDataFrame([("p", "1"), ("p", "1")], "po string, line string")
    rows = rejects.judged(df, rejects.needed(["name"], ["id", "name"]), [("plant", plants, ["plant"], []), ("order", orders, ["po", "line"], ["po", "line"])])
    assert {r.id: list(r._reasons) for r in rows.collect()} == {
        1: [], 2: ["name missing"], 3: ["name missing", "no valid plant", "no valid order"], 4: ["no valid plant", "no valid order"], 5: [],
        None: ["id missing", "no valid order"]}
    assert sorted(r.id for r in rejects.accepted(rows).collect()) == [1, 5] and rejects.accepted(rows).columns == df.columns
    assert rejects.rejected(rows).count() == 4
    assert [r.id for r in rows.where(rejects.only_references_lack()).collect()] == [4]
    counts = {r.reason: r.rows for r in rejects.reason_counts(rows).collect()}
    assert counts == {"name missing": 2, "id missing": 1, "no valid plant": 2, "no valid order": 3}
    assert rejects.judged(df.limit(0), rejects.needed(["name"])).count() == 0
    assert {tuple(r._reasons) for r in rejects.judged(df, []).collect()} == {()}


def test_accepted_and_rejected_are_every_row(spark):
    published = trusted_all(spark, SF0001)
    for d in ("material", "purchase_order", "shipment", "inventory"):
        s, raw, rows = spec(d), fixtures.raw(spark, SF0001, d), foundation_df(spark, SF0001, d)
        early, late = fnd.judged_rows(s, raw), trs.judged_rows(s, rows, published)
        for judged, source, kept in ((early, fnd.standardized(s, raw), fnd.key_filter(s, fnd.standardized(s, raw))), (late, rows, trs.reference_checked(s, trs.business_filter(s, rows), published))):
            ok, bad = rejects.accepted(judged), rejects.rejected(judged).drop(rejects.REASONS)
            kept = kept.select(*ok.columns)
            assert ok.exceptAll(kept).count() == 0 == kept.exceptAll(ok).count(), d
            assert ok.count() + bad.count() == source.count() and bad.exceptAll(source).count() == 0, d


def test_one_scan_of_the_judged_rows(spark, tmp_dir):
    s = spec("shipment")
    foundation_df(spark, SF0001, "shipment").write.parquet(f"{tmp_dir}/f")
    refs = {}
    for r in s.references:
        trusted_all(spark, SF0001)[r.dataset].limit(100).write.parquet(f"{tmp_dir}/{r.dataset}")
        refs[r.dataset] = spark.read.parquet(f"{tmp_dir}/{r.dataset}")
    plan = trs.judged_rows(s, spark.read.parquet(f"{tmp_dir}/f"), refs)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "shipment_id" in line for line in plan.splitlines()) == 1


def test_rejected_rows_judge_each_dataset_once(spark):
    """Orders are referred to by shipments: their plan must not run a second time below them."""
    from stratum.plans.queries import QUERIES

    plan = QUERIES["rejected_rows"](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
    # orders' cleaned rows, shipments' cleaned rows, and shipments again for Trusted
    assert plan.count("l_orderkey#") > 0 and sum(line.lstrip(" :+-").startswith("Relation [l_orderkey") for line in plan.splitlines()) == 3


def test_landed_files_are_dealt_by_the_session(spark, tmp_dir):
    """As many landing files as the session shuffles into, each with all versions of its keys."""
    import glob

    from stratum.plans.queries import land_csv

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        land_csv(fixtures.raw(spark, SF0001, "material"), spec("material"), tmp_dir + "/m")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(glob.glob(tmp_dir + "/m/*.csv")) == 8
    landed = spark.read.option("header", True).csv(tmp_dir + "/m").select("material_id", F.input_file_name().alias("f"))
    assert landed.groupBy(F.upper(F.trim("material_id")).alias("k")).agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0
