"""Spark session defaults and shared-storage locations.

On a cluster the session comes from the platform; these helpers only fill
in settings that are unset (tests, bench).  Nothing here uses a
machine-local temporary folder unless ``spark.checkpoint.dir`` is unset,
which only happens in local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the engine relies on; applied when the builder creates the session.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # INT96 timestamps have no statistics that a filter could use
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "stratum", shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


SCAN_CONF = "spark.sql.files.maxPartitionBytes"
SCAN_BYTES = 16 << 20


def pin_utc(spark: SparkSession) -> None:
    """Contracts hold TIMESTAMP; the inputs hold timestamp_ntz.  Cast in UTC; write microseconds.

    A scan also takes smaller splits than Spark's 128 MB, unless the session
    was given another size: a byte of Parquet becomes twenty of a cleaned row,
    and these are sorted by key in the task that read them.
    """
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    if not spark.sparkContext.getConf().contains(SCAN_CONF):
        spark.conf.set(SCAN_CONF, str(SCAN_BYTES))
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


PARTITIONS_CONF = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARTITION_BYTES = 4 << 20


def fit_partitions(spark: SparkSession, path: str) -> None:
    """Shuffles begin with a partition for each 4 MB of the largest table that is read.

    A task sorts its whole partition, and with a number that does not grow
    with the tables it spills.  Spark puts small partitions together again.
    Fewer than the session's partitions there are never, and a number that the
    session was given stands.
    """
    if spark.sparkContext.getConf().contains(PARTITIONS_CONF):
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    least = int(spark.conf.get(PARTITIONS_CONF, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if (wanted := -(-size // PARTITION_BYTES)) > least:
        spark.conf.set(PARTITIONS_CONF, str(wanted))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in local mode (tests) a
    fresh temporary folder is created and recorded in the session and the
    context.  Unset on a cluster is an error: executors would not share it.
    """
    root = (spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
            or spark.sparkContext.getCheckpointDir())
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"Set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="stratum-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])
