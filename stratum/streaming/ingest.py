"""Raw ingestion with Structured Streaming.

Landing folder -> file stream (each file once, tracked in the checkpoint's
source log) -> ingestion metadata -> by-name alignment to the Raw contract ->
append-only Parquet sink, one folder per ingestion date (the sink's
``_spark_metadata`` log makes the output exactly-once per micro-batch; a
restarted query after a lost executor or driver resumes from the checkpoint
without duplicates).  A micro-batch has one ingestion time, so it writes to
one folder, and the high-water filter skips the folders of earlier days.

The stream needs a schema up front.  For CSV it is taken from the header
(all strings) at every start, with ``enforceSchema=false`` so a file whose
header differs from the first file's fails the batch instead of being bound
by position (D19); the contract alignment then casts by name.  JSON binds by
name natively and reads every payload column as a string.  Parquet carries
its own schema.

A value that cannot be cast becomes null in Raw (D20).  How many did is
counted by column while the stream writes; ``failed_casts`` gives the counts
of a query.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratum.contracts import Contract, contract
from stratum.operators.columns import align_to_contract, rescued
from stratum.plans.jobs import together
from stratum.session import pin_utc, scratch_path

SUPPORTED_FORMATS = ("csv", "json", "parquet")
SUPPORTED_SOURCE_TYPES = ("file",)
SUPPORTED_LOAD_MODES = ("append",)

#: Partition column of the Raw folders: the date (UTC) of ``ingestion_timestamp``.
DATE_COLUMN = "ingestion_date"
RESCUED = "_rescued"  # raw text of what did not fit the contract


@dataclass(frozen=True)
class IngestionConfig:
    """One dataset's ingestion contract (source, target, load, metadata)."""

    name: str
    path: str
    format: str = "csv"
    source_type: str = "file"
    header: bool = True
    delimiter: str = ","
    load_mode: str = "append"
    source_system: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def validated(self) -> "IngestionConfig":
        if self.source_type != "file":
            raise ValueError(f"{self.name}: source type {self.source_type!r} is not one of {list(SUPPORTED_SOURCE_TYPES)}")
        if self.format.lower() not in SUPPORTED_FORMATS:
            raise ValueError(f"{self.name}: format {self.format!r} is not one of {list(SUPPORTED_FORMATS)}")
        if self.load_mode not in SUPPORTED_LOAD_MODES:
            raise ValueError(f"Unsupported load mode: {self.load_mode}. Only 'append' is implemented")
        if not self.source_system:
            raise ValueError(f"Ingestion config '{self.name}' needs metadata.source_system")
        return self


def default_configs(landing_root: str, source_system: str = "sap") -> dict[str, IngestionConfig]:
    """The six datasets: CSV with header, comma separated, one folder each."""
    names = ("material", "plant", "supplier", "purchase_order", "shipment", "inventory")
    return {n: IngestionConfig(n, f"{landing_root.rstrip('/')}/{n}/", source_system=source_system) for n in names}


# --- A1 / A2 -------------------------------------------------------------------------

def source_schema(spark: SparkSession, cfg: IngestionConfig, target: Contract | None = None) -> T.StructType:
    """Schema for the stream: CSV header columns as strings; JSON payload as strings;
    Parquet from the files.  Reading a CSV header touches the first line only."""
    fmt = cfg.format.lower()
    if fmt == "csv":
        reader = spark.read.option("header", cfg.header).option("sep", cfg.delimiter)
        for k, v in cfg.options.items():
            reader = reader.option(k, v)
        payload = _payload(target) if target is not None else None
        try:
            schema = reader.csv(cfg.path).schema
        except AnalysisException as e:
            if payload is None or e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return payload  # an empty landing folder: nothing to read yet
        if cfg.header:
            return schema
        if payload is None or len(payload) != len(schema):
            raise ValueError(f"{cfg.name}: {len(schema)} columns without a header cannot be bound to the contract's payload columns")
        return payload  # without a header the order is the contract's
    if fmt == "json":
        if target is None:
            raise ValueError("JSON sources need the target contract to name their columns")
        return _payload(target)
    reader = spark.read
    for k, v in cfg.options.items():
        reader = reader.option(k, v)
    return reader.parquet(cfg.path).schema


def _payload(target: Contract) -> T.StructType:
    """The contract's columns that a landing file holds, as strings."""
    meta = {"source_system", "source_file", "ingestion_batch_id", "ingestion_timestamp"}
    return T.StructType([T.StructField(c, T.StringType()) for c in target.names if c not in meta])


def read_file_stream(spark: SparkSession, cfg: IngestionConfig, schema: T.StructType | None = None,
                     target: Contract | None = None) -> DataFrame:
    """A1: new files under ``cfg.path``, each processed once per checkpoint."""
    cfg = cfg.validated()
    fmt = cfg.format.lower()
    schema = schema or source_schema(spark, cfg, target)
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", cfg.header).option("sep", cfg.delimiter).option("enforceSchema", False)
    for k, v in cfg.options.items():
        reader = reader.option(k, v)
    return reader.load(cfg.path)


# --- C1 ----------------------------------------------------------------------------

def add_ingestion_metadata(df: DataFrame, source_system: str, batch_id: str, run_ts: Column | None = None) -> DataFrame:
    """Landing file path, configured source system (replacing a payload column of
    that name), run batch id, and the micro-batch time (``run_ts`` to give another)."""
    return df.withColumns({
        "source_file": F.col("_metadata.file_path"),
        "source_system": F.lit(source_system),
        "ingestion_batch_id": F.lit(batch_id),
        "ingestion_timestamp": F.current_timestamp() if run_ts is None else run_ts,
    })


def new_batch_id() -> str:
    return time.strftime("%Y%m%d%H%M%S", time.gmtime()) + "-" + uuid.uuid4().hex[:8]


def landed_target(schema: T.StructType) -> T.StructType:
    """Raw target for a source without a contract: its columns + the metadata columns."""
    meta = contract("material", "raw").columns[-4:]
    names = {m.name for m in meta}
    return T.StructType([f for f in schema.fields if f.name not in names] + [m.field() for m in meta])


# --- B1 / B2 / J1 / J2 / J4 -----------------------------------------------------------

def ingest_raw(
    spark: SparkSession,
    cfg: IngestionConfig,
    target_path: str,
    checkpoint_path: str,
    target: Contract | T.StructType | None = None,
    continuous: bool = False,
    processing_time: str | None = None,
    strict: bool = False,
    batch_id: str | None = None,
    run_ts: Column | None = None,
) -> StreamingQuery:
    """B2: source -> metadata -> align -> append sink; returns the query.

    ``continuous=False`` (J1) processes what is there with
    ``trigger(availableNow=True)`` and blocks until done; ``continuous=True``
    (J2) keeps the query running (default micro-batch trigger or
    ``processing_time``) and returns at once.  ``run_ts`` replaces the
    micro-batch time (reproducible runs).
    """
    cfg = cfg.validated()
    pin_utc(spark)
    _refuse_undated(spark, target_path)
    if target is None:
        target = contract(cfg.name, "raw")
    tcontract = target if isinstance(target, Contract) else None
    df = read_file_stream(spark, cfg, target=tcontract)
    schema = target.schema() if isinstance(target, Contract) else target
    df = add_ingestion_metadata(df, cfg.source_system, batch_id or new_batch_id(), run_ts)
    lost = None if strict else rescued(df, schema)
    aligned = align_to_contract(df if lost is None else df.withColumn(RESCUED, lost), _with_rescued(schema, lost is not None), strict=strict)
    df = aligned.withColumn(DATE_COLUMN, F.to_date("ingestion_timestamp"))
    writer = (df.writeStream.format("parquet").outputMode("append").partitionBy(DATE_COLUMN)
              .option("checkpointLocation", checkpoint_path).queryName(f"raw_{cfg.name}_{uuid.uuid4().hex[:6]}"))
    if not continuous:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with unsorted_folders(spark):
        query = writer.start(target_path)
    if not continuous:
        query.awaitTermination()
    return query


WRITERS_CONF = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def unsorted_folders(spark: SparkSession):
    """A stream that is started in it keeps the file of a folder open in place of sorting its rows by folder first.

    A micro-batch has one ingestion date, so one folder; a task that met more than two would sort the rest.
    """
    held = spark.conf.get(WRITERS_CONF)
    if held != "0":  # given, or set around several streams
        yield
        return
    spark.conf.set(WRITERS_CONF, "2")
    try:
        yield
    finally:
        spark.conf.set(WRITERS_CONF, held)


def _refuse_undated(spark: SparkSession, path: str) -> None:
    """A Raw folder with files outside of the date folders was written by another layout: mixed, it could not be read."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(p) and any(st.isFile() and st.getPath().getName().endswith(".parquet") for st in fs.listStatus(p)):
        raise ValueError(f"{path} holds files that are not in folders by {DATE_COLUMN}")


def _with_rescued(schema: T.StructType, there: bool = True) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(RESCUED, T.VariantType())]) if there else schema


def rescued_values(spark: SparkSession, path: str, target: Contract) -> DataFrame:
    """What did not fit the contract, one row for each value in the Raw table at ``path``.

    ``ingestion_batch_id`` and ``ingestion_timestamp`` name the run and the
    micro-batch, ``kind`` is ``cast`` or ``extra``, ``value`` the raw text.
    Rescued values are stored with their rows by the sink that commits a
    micro-batch once, so a batch that is tried again is held once, and no
    batch is forgotten.
    """
    rows = spark.read.schema(_with_rescued(raw_schema(target))).parquet(path).where(F.col(RESCUED).isNotNull())
    entries = F.explode(F.from_json(F.to_json(RESCUED), "map<string,string>")).alias("column_name", "value")
    kind = F.when(F.col("column_name").isin(target.names), "cast").otherwise("extra")
    return rows.select("source_file", "ingestion_batch_id", "ingestion_timestamp", entries).withColumn("kind", kind)


def rescued_counts(spark: SparkSession, path: str, target: Contract) -> DataFrame:
    """Rescued values of each micro-batch, column and kind."""
    return rescued_values(spark, path, target).groupBy("ingestion_batch_id", "ingestion_timestamp", "column_name", "kind").agg(F.count(F.lit(1)).alias("rows"))


def failed_casts(spark: SparkSession, path: str, target: Contract) -> dict[str, int]:
    """How many values of each column of the Raw table became null because they could not be cast."""
    counts = rescued_values(spark, path, target).where("kind = 'cast'").groupBy("column_name").count()
    return {r["column_name"]: r["count"] for r in counts.collect()}  # as many rows as columns at most


# --- P13 / J5 ------------------------------------------------------------------------

def select_datasets(selection: str, available: Sequence[str]) -> list[str]:
    """``all`` or a comma list (trimmed, lower-cased); unknown or empty is an error."""
    items = [s.strip().lower() for s in (selection or "").split(",") if s.strip()]
    if not items:
        raise ValueError("No datasets selected")
    if items == ["all"]:
        return list(available)
    unknown = sorted(set(items) - set(available))
    if unknown:
        raise ValueError(f"Unknown datasets: {unknown}. Available: {sorted(available)}")
    return [a for a in available if a in items]


def raw_paths(root: str, dataset: str) -> tuple[str, str]:
    """(table path, checkpoint path) of one Raw dataset under a shared root."""
    base = f"{root.rstrip('/')}/raw/{dataset}"
    return f"{base}/data", f"{base}/_checkpoint"


def run_raw_ingestion(spark: SparkSession, configs: Mapping[str, IngestionConfig], selection: str, root: str,
                      continuous: bool = False, processing_time: str | None = None,
                      run_ts: Column | None = None) -> list[StreamingQuery]:
    """One stream per selected dataset, running together (in continuous mode the caller may
    ``awaitAnyTermination``)."""
    batch_id = new_batch_id()
    names = select_datasets(selection, list(configs))
    with unsorted_folders(spark):
        return list(together({n: partial(ingest_raw, spark, configs[n], *raw_paths(root, n), continuous=continuous,
                                         processing_time=processing_time, batch_id=batch_id, run_ts=run_ts) for n in names}).values())


def await_any(spark: SparkSession, timeout_seconds: float | None = None) -> bool:
    """J5, continuous mode: block until any running ingestion stream stops (or fails,
    in which case its exception is raised here).  Streams that ended before
    the call (e.g. earlier available-now runs) are forgotten first."""
    spark.streams.resetTerminated()
    if timeout_seconds is None:
        spark.streams.awaitAnyTermination()
        return True
    return spark.streams.awaitAnyTermination(int(timeout_seconds))


def read_raw(spark: SparkSession, root: str, dataset: str, target: Contract | None = None, dated: bool = False) -> DataFrame:
    """A3 for the Raw layer: the committed files of the stream sink, with the contract's columns.

    ``dated`` adds the folders' ``DATE_COLUMN``; the incremental Foundation job prunes by it.
    """
    data, _ = raw_paths(root, dataset)
    target = target or contract(dataset, "raw")
    df = spark.read.schema(raw_schema(target)).parquet(data)
    return df if dated else df.select(*target.names)


def raw_schema(target: Contract) -> T.StructType:
    """The stored columns of a Raw table."""
    return T.StructType([*target.schema().fields, T.StructField(DATE_COLUMN, T.DateType())])


# --- registered query ----------------------------------------------------------------

EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def ingest_available_now_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the ``events`` test table in available-now mode into a fresh Raw
    folder (under the shared checkpoint root), run again (no new file, so no
    new row), then read what was committed, with the ingestion metadata."""
    cfg = IngestionConfig("events", sf_dir.rstrip("/") + "/", format="parquet", source_system="sap",
                          options={"pathGlobFilter": "events.parquet"})
    root = scratch_path(spark, "ingest")
    data, ckpt = raw_paths(root, "events")
    target = landed_target(source_schema(spark, cfg))
    for run in ("run-1", "run-2"):
        ingest_raw(spark, cfg, data, ckpt, target=target, batch_id=run)
    return spark.read.schema(target).parquet(data).select(
        *EVENT_COLUMNS, "source_system", F.substring_index("source_file", "/", -1).alias("source_file"),
        "ingestion_batch_id", F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_timestamp"))
