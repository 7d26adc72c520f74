"""A key holding a third of all rows: results stay whole and the hot group is
reduced before the shuffle (partial WindowGroupLimit), not sent to one task."""

from pyspark.sql import functions as F

from stratum.operators.dedupe import latest_per_key
from stratum.operators.refcheck import check_mandatory, check_optional


def _nodes(plan):
    yield plan
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):  # AQE stages are leaves holding a plan
        yield from _nodes(plan.plan())
        return
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def _shuffle_records(df):
    qe = df._jdf.queryExecution().executedPlan()
    root = qe.executedPlan() if qe.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else qe
    total = 0
    for n in _nodes(root):
        if n.getClass().getSimpleName() == "ShuffleExchangeExec":
            total += n.metrics().apply("shuffleRecordsWritten").value()
    return total


def _hot(spark, n=60_000, parts=8):
    # a third of the rows share key 0; the rest are unique keys
    return (spark.range(0, n, 1, parts)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                    F.col("id").alias("v"),
                    (F.col("id") % 1000).cast("timestamp").alias("t")))


def test_hot_key_latest_is_whole_and_pre_reduced(spark):
    df = _hot(spark)
    out = latest_per_key(df, ["k"], "t", ["v"])
    rows = out.collect()
    assert len(rows) == 1 + 40_000  # every key kept once, no row dropped
    hot = [r for r in rows if r.k == 0][0]
    best = df.filter("k = 0").orderBy(F.col("t").desc(), F.col("v").desc()).first()
    assert (hot.t, hot.v) == (best.t, best.v)
    # 20,000 hot rows collapse to at most one per map task before the exchange
    assert 40_000 < _shuffle_records(out) <= 40_000 + 8


def test_hot_reference_key_semi_join(spark):
    facts = _hot(spark).withColumn("ss", F.lit("SAP"))
    ref = spark.createDataFrame([("SAP", 0), ("SAP", 5)], "ss string, k long")
    kept = check_mandatory(facts, ref, ["ss", "k"]).count()
    assert kept == 20_000 + 1


def test_hot_null_reference_does_not_enter_join(spark):
    facts = _hot(spark).select(F.lit("SAP").alias("ss"),
                               F.when(F.col("k") == 0, F.lit(None)).otherwise(F.col("k").cast("string")).alias("po"),
                               F.when(F.col("k") == 0, F.lit(None)).otherwise(F.lit("1")).alias("line"))
    ref = spark.createDataFrame([("SAP", "1", "1")], "ss string, po string, line string")
    out = check_optional(facts, ref, ["ss", "po", "line"], ["po", "line"])
    assert out.count() == 20_000 + 1


def test_null_references_spread_over_partitions(spark):
    facts = spark.range(0, 4000, 1, 4).select(F.col("id").alias("v"), F.lit("SAP").alias("ss"),
                                              F.lit(None).cast("string").alias("po"), F.lit(None).cast("string").alias("line"))
    ref = spark.createDataFrame([("SAP", "1", "1")], "ss string, po string, line string")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        out = check_optional(facts, ref, ["ss", "po", "line"], ["po", "line"])
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and len(sizes) > 1 and max(sizes) < 2000
