"""Table contracts for the six datasets in the three layers.

A contract is an ordered list of typed columns with a nullability flag and a
comment.  Raw, Foundation and Trusted contracts are derived from one payload
description per dataset by fixed rules, so the 18 contracts cannot drift apart:

* Raw        = payload (all nullable) + the four ingestion metadata columns.
* Foundation = payload (business-required columns NOT NULL) + source_system,
               source_record_id, [source_ingestion_timestamp], two record
               timestamps.
* Trusted    = Foundation without source_record_id / source_ingestion_timestamp.

Departures from the reference contracts (documented in README):
* plant, supplier and purchase_order Foundation tables carry
  ``source_ingestion_timestamp TIMESTAMP``; the purchase-order table no longer
  declares the never-filled ``source_updated_timestamp STRING``.  The
  incremental high-water mark reads the new column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STRING = T.StringType()
DATE = T.DateType()
TIMESTAMP = T.TimestampType()
QUANTITY = T.DecimalType(18, 4)

LAYERS = ("raw", "foundation", "trusted")


@dataclass(frozen=True)
class Column:
    name: str
    dtype: T.DataType
    nullable: bool = True
    comment: str = ""

    def field(self) -> T.StructField:
        meta = {"comment": self.comment} if self.comment else {}
        return T.StructField(self.name, self.dtype, self.nullable, meta)


@dataclass(frozen=True)
class Contract:
    dataset: str
    layer: str
    columns: tuple[Column, ...]
    comment: str = ""

    @property
    def name(self) -> str:
        return f"{self.layer}.{self.dataset}"

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def schema(self) -> T.StructType:
        return T.StructType([c.field() for c in self.columns])

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(name)


# --- payload columns per dataset -------------------------------------------------
# Names, types, order and required columns must match the original tables.
# (name, type, required-from-foundation-on)
_PAYLOAD: dict[str, list[tuple[str, T.DataType, bool]]] = {
    "material": [
        ("material_id", STRING, True),
        ("material_name", STRING, False),
        ("material_type", STRING, False),
        ("unit_of_measure", STRING, False),
        ("product_group", STRING, False),
    ],
    "plant": [
        ("plant_id", STRING, True),
        ("plant_name", STRING, False),
        ("plant_type", STRING, False),
        ("city", STRING, False),
        ("state", STRING, False),
        ("country", STRING, False),
    ],
    "supplier": [
        ("supplier_id", STRING, True),
        ("supplier_name", STRING, False),
        ("supplier_type", STRING, False),
        ("city", STRING, False),
        ("state", STRING, False),
        ("country", STRING, False),
    ],
    "purchase_order": [
        ("purchase_order_id", STRING, True),
        ("purchase_order_line", STRING, True),
        ("material_id", STRING, True),
        ("supplier_id", STRING, True),
        ("plant_id", STRING, True),
        ("order_date", DATE, False),
        ("requested_delivery_date", DATE, False),
        ("order_quantity", QUANTITY, False),
        ("unit_of_measure", STRING, False),
        ("order_status", STRING, False),
    ],
    "shipment": [
        ("shipment_id", STRING, True),
        ("purchase_order_id", STRING, False),
        ("purchase_order_line", STRING, False),
        ("material_id", STRING, True),
        ("supplier_id", STRING, True),
        ("plant_id", STRING, True),
        ("shipment_date", DATE, False),
        ("actual_delivery_date", DATE, False),
        ("shipped_quantity", QUANTITY, False),
        ("received_quantity", QUANTITY, False),
        ("shipment_status", STRING, False),
        ("carrier_name", STRING, False),
        ("transport_mode", STRING, False),
    ],
    "inventory": [
        ("inventory_snapshot_date", DATE, True),
        ("material_id", STRING, True),
        ("plant_id", STRING, True),
        ("storage_location", STRING, False),
        ("available_quantity", QUANTITY, False),
        ("blocked_quantity", QUANTITY, False),
        ("in_transit_quantity", QUANTITY, False),
        ("unit_of_measure", STRING, False),
    ],
}

DATASETS = tuple(_PAYLOAD)
MASTER_DATASETS = ("material", "plant", "supplier")
FACT_DATASETS = ("purchase_order", "shipment", "inventory")

# Foundation tables that keep the Raw ingestion time of the winning row.
_KEEPS_INGESTION_TIME = {"plant", "supplier", "purchase_order"}

RAW_METADATA = (
    Column("source_system", STRING, False, "Source system constant set at ingestion"),
    Column("source_file", STRING, True, "Path of the landing file the row came from"),
    Column("ingestion_batch_id", STRING, False, "Identifier of the ingestion run"),
    Column("ingestion_timestamp", TIMESTAMP, False, "Time the micro-batch was processed"),
)


def payload_columns(dataset: str) -> list[str]:
    return [name for name, _, _ in _PAYLOAD[dataset]]


def _raw(dataset: str) -> Contract:
    cols = tuple(Column(n, t, True) for n, t, _ in _PAYLOAD[dataset]) + RAW_METADATA
    return Contract(dataset, "raw", cols, f"Raw {dataset} rows as received plus ingestion metadata")


def _foundation(dataset: str) -> Contract:
    cols = [Column(n, t, not req) for n, t, req in _PAYLOAD[dataset]]
    cols.append(Column("source_system", STRING, False, "Upper-cased source system"))
    cols.append(Column("source_record_id", STRING, True, "Identifier of the source record"))
    if dataset in _KEEPS_INGESTION_TIME:
        cols.append(Column("source_ingestion_timestamp", TIMESTAMP, True,
                           "Raw ingestion time of the published version"))
    cols.append(Column("record_created_timestamp", TIMESTAMP, False, "First publish time"))
    cols.append(Column("record_updated_timestamp", TIMESTAMP, False, "Last publish time"))
    return Contract(dataset, "foundation", tuple(cols), f"Standardised latest {dataset} per business key")


def _trusted(dataset: str) -> Contract:
    dropped = {"source_record_id", "source_ingestion_timestamp"}
    cols = tuple(c for c in _foundation(dataset).columns if c.name not in dropped)
    return Contract(dataset, "trusted", cols, f"Validated {dataset} with references checked")


_BUILDERS = {"raw": _raw, "foundation": _foundation, "trusted": _trusted}


def contract(dataset: str, layer: str) -> Contract:
    if dataset not in _PAYLOAD:
        raise ValueError(f"Unknown dataset: {dataset}. Expected one of {sorted(_PAYLOAD)}")
    if layer not in _BUILDERS:
        raise ValueError(f"Unknown layer: {layer}. Expected one of {list(LAYERS)}")
    return _BUILDERS[layer](dataset)


def all_contracts() -> list[Contract]:
    return [contract(d, layer) for layer in LAYERS for d in DATASETS]
