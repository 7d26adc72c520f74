"""Foundation layer job (P1-P6): Raw -> standardised latest version per business key.

Plan shape for every dataset: scan -> [incremental filter pushed to the scan]
-> one cleaning projection -> key filter -> top-1 per key (one shuffle on the
business key with map-side ``WindowGroupLimit``) -> projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.contracts import contract
from stratum.functions import clean
from stratum.functions.predicates import requirement
from stratum.operators.columns import project
from stratum.operators.dedupe import latest_per_key
from stratum.operators.rejects import judged, needed
from stratum.operators.watermark import incremental_filter
from stratum.plans.specs import DatasetSpec, RecordId

RECORD_ID = "source_record_id"


def record_id_expr(rid: RecordId) -> Column:
    if rid.kind == "copy":
        return clean.record_id_copy(rid.columns[0])
    if rid.kind == "concat_skip_null":
        return clean.record_id_concat_skip_null(rid.columns)
    if rid.kind == "concat_keep_empty":
        return clean.record_id_concat_keep_empty(rid.columns)
    raise ValueError(f"Unknown record id kind: {rid.kind}")


def standardized(spec: DatasetSpec, raw: DataFrame) -> DataFrame:
    """Record id (before cleaning unless D11 says after) + trim -> null tokens -> upper."""
    extra = {} if spec.record_id.after_dedupe else {RECORD_ID: record_id_expr(spec.record_id)}
    return clean.standardize(raw, trim=spec.trim, null_tokens=spec.null_tokens, upper=spec.upper, extra=extra)


def key_filter(spec: DatasetSpec, df: DataFrame) -> DataFrame:
    """F1/F2."""
    return df.filter(requirement(spec.present, spec.not_null))


def judged_rows(spec: DatasetSpec, raw: DataFrame) -> DataFrame:
    """Cleaned Raw rows with every reason that keeps them out of Foundation; none for those that ``key_filter`` takes."""
    return judged(standardized(spec, raw), needed(spec.present, spec.not_null))


def latest(spec: DatasetSpec, df: DataFrame) -> DataFrame:
    """W1 with the spec's total tie-break order."""
    out = latest_per_key(df, spec.keys, spec.order_column, spec.dedupe_tiebreak())
    if spec.record_id.after_dedupe:
        out = out.withColumn(RECORD_ID, record_id_expr(spec.record_id))
    return out


def foundation(spec: DatasetSpec, raw: DataFrame, run_ts: Column | None = None, mark=None) -> DataFrame:
    """The Foundation rows of one run, in the Foundation contract.

    ``run_ts`` stamps both record timestamps (C8; default ``current_timestamp()``,
    a fixed literal makes runs reproducible).  ``mark`` is the high-water mark
    for incremental datasets (F6); ``None`` reads all of Raw.
    """
    run_ts = F.current_timestamp() if run_ts is None else run_ts
    if spec.incremental:
        raw = incremental_filter(raw, mark, spec.order_column)
    return published_form(spec, latest(spec, key_filter(spec, standardized(spec, raw))), run_ts)


def published_form(spec: DatasetSpec, df: DataFrame, run_ts: Column) -> DataFrame:
    """The latest rows in the Foundation contract."""
    target = contract(spec.name, "foundation")
    renames = {"source_ingestion_timestamp": spec.order_column} if "source_ingestion_timestamp" in target.names else {}
    return project(df, target, renames=renames,
                   computed={"record_created_timestamp": run_ts, "record_updated_timestamp": run_ts})
