"""Session settings that the plans rely on."""

from pyspark.sql import functions as F

from stratum.session import PARTITION_BYTES, PARTITIONS_CONF, SCAN_BYTES, SCAN_CONF, fit_partitions, pin_utc


def test_scans_take_small_splits(spark, tmp_dir):
    """Rows of a split are sorted by the task that reads it: 128 MB of Parquet spill."""
    before = spark.conf.get(SCAN_CONF)
    try:
        spark.conf.set(SCAN_CONF, "128MB")
        pin_utc(spark)
        assert int(spark.conf.get(SCAN_CONF)) == SCAN_BYTES
        spark.range(4_000_000).select(F.xxhash64("id").alias("x"), F.xxhash64("id", F.lit(1)).alias("y"), F.xxhash64("id", F.lit(2)).alias("z")).coalesce(1).write.option("parquet.block.size", 4 << 20).parquet(tmp_dir + "/t")
        assert spark.read.parquet(tmp_dir + "/t").rdd.getNumPartitions() >= 6  # 96 MB; 4 on 4 cores at 128 MB
    finally:
        spark.conf.set(SCAN_CONF, before)


def test_shuffles_have_more_partitions_for_larger_tables(spark, tmp_dir):
    """A reducing task sorts its partition: with a fixed number it spills on large tables."""
    rows = spark.range(4_000_000).select(F.xxhash64("id").alias("x"))
    rows.write.parquet(f"{tmp_dir}/large")
    rows.limit(10).write.parquet(f"{tmp_dir}/small")
    before = spark.conf.get(PARTITIONS_CONF, None)
    try:
        spark.conf.unset(PARTITIONS_CONF)
        fit_partitions(spark, f"{tmp_dir}/small")
        assert spark.conf.get(PARTITIONS_CONF, None) is None
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        fit_partitions(spark, f"{tmp_dir}/large")  # 32 MB
        assert 32_000_000 / PARTITION_BYTES <= int(spark.conf.get(PARTITIONS_CONF)) <= 12
        fit_partitions(spark, f"{tmp_dir}/small")  # never fewer than another table asked for
        assert int(spark.conf.get(PARTITIONS_CONF)) > 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset(PARTITIONS_CONF) if before is None else spark.conf.set(PARTITIONS_CONF, before)
