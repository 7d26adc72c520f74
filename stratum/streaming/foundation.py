"""Incremental Foundation over the Raw table with Structured Streaming.

The batch Foundation jobs re-deduplicate the whole Raw history on every run
(only purchase orders use a high-water mark).  Driven as a stream, each run
reads only the Raw files committed since the last run — the file source's
checkpoint log records which files were consumed — and publishes
``upsert(published, latest_per_key(new rows))`` per micro-batch.

This equals the full recomputation because ``ingestion_timestamp`` is the
processing time of the Raw micro-batch that wrote a row: every row of a
later delivery is newer than every row already published, so the newest
version of a key in the new rows always wins, exactly as it would in a
window over all of Raw.  A retried micro-batch publishes the same rows again,
which leaves the same state.  A micro-batch of which no row is accepted publishes nothing.

That holds while files arrive in the order of their rows.  ``latest_stream``
asks for no order: it keeps the latest row of each key, by the columns of W1,
as the state of a streaming aggregation, so the rows of a late file lose to a
newer one of an earlier micro-batch.  There is no watermark (J6): no row is too
late, and the state holds as many rows as the published table.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stratum.contracts import contract
from stratum.plans import foundation as fnd
from stratum.plans.specs import DatasetSpec
from stratum.session import pin_utc
from stratum.sources.tables import ChangeTable, SnapshotTable
from stratum.streaming.ingest import raw_schema


def foundation_stream(
    spark: SparkSession,
    s: DatasetSpec,
    raw_path: str,
    table: ChangeTable | SnapshotTable,
    checkpoint_path: str,
    run_ts: Column | None = None,
    continuous: bool = False,
    null_safe: bool = True,
) -> StreamingQuery:
    """Publish Foundation for ``s`` from the Raw Parquet folder at ``raw_path``.

    Available-now by default (process the new Raw files, publish, stop); with
    ``continuous=True`` the query keeps running and publishes per micro-batch.
    """
    pin_utc(spark)
    batch_spec = replace(s, incremental=False)
    raw = spark.readStream.schema(raw_schema(contract(s.name, "raw"))).parquet(raw_path)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        source = fnd.foundation(batch_spec, batch, F.current_timestamp() if run_ts is None else run_ts)
        table.upsert(source, s.keys, s.preserve_on_update, null_safe, s.nullable_keys())

    writer = raw.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint_path)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    query = writer.start()
    if not continuous:
        query.awaitTermination()
    return query


def latest_rows(s: DatasetSpec, raw: DataFrame) -> DataFrame:
    """W1 as an aggregation, for batches and streams: of each key the greatest row by the order column, then the tie-break.

    Structs compare field by field with nulls least, which is the order ``latest_per_key`` ranks by.
    The greatest struct begins with those columns and ends with the others, so the state holds each value once.
    """
    rows = fnd.key_filter(s, fnd.standardized(s, raw))
    order = [s.order_column, *s.dedupe_tiebreak()]
    others = [c for c in rows.columns if c not in (*s.keys, *order)]
    row = F.struct(*[c for c in order if c not in s.keys], *others)
    out = rows.groupBy(*s.keys).agg(F.max(row).alias("_row")).select(*s.keys, "_row.*").select(*rows.columns)
    return out.withColumn(fnd.RECORD_ID, fnd.record_id_expr(s.record_id)) if s.record_id.after_dedupe else out


def latest_stream(spark: SparkSession, s: DatasetSpec, raw_path: str, table: ChangeTable | SnapshotTable, checkpoint_path: str,
                  run_ts: Column | None = None, continuous: bool = False, null_safe: bool = True) -> StreamingQuery:
    """Publish Foundation for ``s`` from Raw files in any order of arrival.

    Update mode: a micro-batch publishes the latest row of each key that it
    touched, so one that a late row left as it was is published once more.
    The state is Spark's and lives with the checkpoint; a restarted query goes
    on from it.  With ``continuous`` the query keeps running and is returned at
    once.  The state lies in RocksDB, with bounded memory, and need not fit in
    the executors; settings that the session was given stand.
    """
    pin_utc(spark)
    raw = spark.readStream.schema(raw_schema(contract(s.name, "raw"))).parquet(raw_path)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        source = fnd.published_form(s, batch, F.current_timestamp() if run_ts is None else run_ts)
        table.upsert(source, s.keys, s.preserve_on_update, null_safe, s.nullable_keys())

    writer = latest_rows(s, raw).writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", checkpoint_path)
    with state_on_disk(spark, continuous):
        query = (writer if continuous else writer.trigger(availableNow=True)).start()
    if not continuous:
        query.awaitTermination()
    return query


_STORE = "spark.sql.streaming.stateStore"
_CHANGELOG = f"{_STORE}.rocksdb.changelogCheckpointing.enabled"
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    _CHANGELOG: "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.maintenanceInterval": "10s",
}


@contextmanager
def state_on_disk(spark: SparkSession, continuous: bool = False):
    """A stream that is started in it keeps its state in RocksDB (a query takes its settings when it starts).

    The few, large micro-batches of an available-now run store the files of
    RocksDB; a running query, whose micro-batches are small, stores what they
    changed.  Each goes on from what the other has left.  Rows are not counted,
    which looks every key up once more, and the stores of queries that ended
    give their share of the memory back within ten seconds, not a minute.
    """
    before = spark.sparkContext.getConf()
    chosen = {k: v for k, v in (STATE_CONF | {_CHANGELOG: str(continuous).lower()}).items() if not before.contains(k)}
    held = {k: spark.conf.get(k, None) for k in chosen}
    for k, v in chosen.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
