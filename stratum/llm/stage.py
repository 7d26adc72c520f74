"""Written intermediate tables in the cluster's shared folder.

``staged`` writes a frame as Parquet under ``spark.checkpoint.dir`` and reads
it back: the lineage is cut, lost executors recompute nothing before it, and
every executor can read it.  The schema is given to the reader, so an empty
table reads back as an empty table.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stratum.session import scratch_path


#: Rows of a batch that goes to a Python worker, where rows hold texts; Spark's 10,000 are tens of MB, in the JVM and in the worker.
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run within the block sends ``BATCH_ROWS`` rows at most at a time to a Python worker."""
    before = int(spark.conf.get(BATCH_CONF))
    if not 0 < before <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, str(before))


def staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """``staged`` for tables that are read within the ``with`` block alone: their folders go when it ends.

    What was made of them has to be written by then, so that nothing is computed from them again.
    Spark removes the shuffle files of finished steps when the driver collects its garbage, which
    is asked for here; else they would lie beside those of the next steps.
    """
    paths: list[str] = []

    def put(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, "llm", name))
        df.write.option("compression", "zstd").parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield put
    finally:
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
