"""One declarative spec per dataset: everything the Foundation and Trusted jobs need.

The twelve per-dataset jobs of the original pipeline differ only in these
values; ``stratum.plans.foundation`` and ``stratum.plans.trusted`` interpret
them with the same operators.  The key, trim, null-token, upper-case and
filter lists are fixed values: results must equal those of the original jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from stratum.contracts import payload_columns


@dataclass(frozen=True)
class RecordId:
    """How ``source_record_id`` is built (E8-E10) and when."""

    kind: str  # "copy" | "concat_skip_null" | "concat_keep_empty"
    columns: tuple[str, ...]
    after_dedupe: bool = False


@dataclass(frozen=True)
class Reference:
    """A reference check against a Trusted dataset (G1 mandatory, G2 optional)."""

    dataset: str
    keys: tuple[str, ...]
    optional: tuple[str, ...] = ()  # key parts that may all be null (G2 + F5)


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    keys: tuple[str, ...]
    record_id: RecordId
    trim: tuple[str, ...]
    null_tokens: tuple[str, ...]
    upper: tuple[str, ...]
    # Foundation key filter: not null and not "" / not null only
    present: tuple[str, ...]
    not_null: tuple[str, ...]
    preserve_on_update: tuple[str, ...]
    # Trusted business filter
    trusted_present: tuple[str, ...]
    trusted_not_null: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    incremental: bool = False
    order_column: str = "ingestion_timestamp"
    partition_by: tuple[str, ...] = ()
    tiebreak: tuple[str, ...] = field(default=())

    def nullable_keys(self) -> tuple[str, ...]:
        """Key columns that may be null in Foundation/Trusted (merge with ``<=>``)."""
        from stratum.contracts import contract

        c = contract(self.name, "foundation")
        return tuple(k for k in self.keys if c.column(k).nullable)

    def dedupe_tiebreak(self) -> tuple[str, ...]:
        """Landing file, then every payload column that is not a key."""
        if self.tiebreak:
            return self.tiebreak
        return ("source_file", *[c for c in payload_columns(self.name) if c not in self.keys])


SS = "source_system"
CREATED = "record_created_timestamp"

MATERIAL = DatasetSpec(
    name="material",
    keys=(SS, "material_id"),
    record_id=RecordId("copy", ("material_id",)),
    trim=("material_id", "material_name", "material_type", "unit_of_measure", "product_group", SS),
    null_tokens=("material_id", "material_name", "material_type", "unit_of_measure", "product_group"),
    upper=("material_id", "material_type", "unit_of_measure", SS),
    present=(),
    not_null=("material_id", SS),
    preserve_on_update=(CREATED,),
    trusted_present=("material_id", "material_name"),
)

PLANT = DatasetSpec(
    name="plant",
    keys=(SS, "plant_id"),
    record_id=RecordId("copy", ("plant_id",)),
    trim=("plant_id", "plant_name", "plant_type", "city", "state", "country", SS),
    null_tokens=("plant_id", "plant_name", "plant_type", "city", "state", "country", SS),
    upper=("plant_id", "plant_type", "country", SS),
    present=(),
    not_null=("plant_id", SS),
    preserve_on_update=(CREATED,),
    trusted_present=("plant_id", "plant_name", SS),
)

SUPPLIER = DatasetSpec(
    name="supplier",
    keys=(SS, "supplier_id"),
    record_id=RecordId("copy", ("supplier_id",)),
    trim=("supplier_id", "supplier_name", "supplier_type", "city", "state", "country", SS),
    null_tokens=("supplier_id", "supplier_name", "supplier_type", "city", "state", "country", SS),
    upper=("supplier_id", "supplier_type", "country", SS),
    present=(),
    not_null=("supplier_id", SS),
    preserve_on_update=(CREATED,),
    trusted_present=("supplier_id", "supplier_name", SS),
)

_PO_UPPER = ("purchase_order_id", "material_id", "supplier_id", "plant_id", "unit_of_measure", "order_status", SS)
PURCHASE_ORDER = DatasetSpec(
    name="purchase_order",
    keys=(SS, "purchase_order_id", "purchase_order_line"),
    record_id=RecordId("concat_skip_null", ("purchase_order_id", "purchase_order_line")),
    trim=(*_PO_UPPER, "purchase_order_line"),
    null_tokens=(),
    upper=_PO_UPPER,
    present=("purchase_order_id", "purchase_order_line", "material_id", "supplier_id", "plant_id", SS),
    not_null=(),
    preserve_on_update=(CREATED,),
    trusted_present=("purchase_order_id", "purchase_order_line"),
    trusted_not_null=("material_id", "supplier_id", "plant_id", SS),
    references=(
        Reference("material", (SS, "material_id")),
        Reference("supplier", (SS, "supplier_id")),
        Reference("plant", (SS, "plant_id")),
    ),
    incremental=True,
)

_SHP_UPPER = ("shipment_id", "purchase_order_id", "material_id", "supplier_id", "plant_id",
              "shipment_status", "transport_mode", SS)
SHIPMENT = DatasetSpec(
    name="shipment",
    keys=(SS, "shipment_id"),
    record_id=RecordId("copy", ("shipment_id",)),
    trim=(*_SHP_UPPER, "purchase_order_line", "carrier_name"),
    null_tokens=(),
    upper=_SHP_UPPER,
    present=("shipment_id", "material_id", "supplier_id", "plant_id", SS),
    not_null=(),
    preserve_on_update=(CREATED,),  # D3 fix; parity: ()
    trusted_present=("shipment_id", "material_id", "supplier_id", "plant_id", SS),
    references=(
        Reference("material", (SS, "material_id")),
        Reference("supplier", (SS, "supplier_id")),
        Reference("plant", (SS, "plant_id")),
        Reference("purchase_order", (SS, "purchase_order_id", "purchase_order_line"),
                  optional=("purchase_order_id", "purchase_order_line")),
    ),
)

_INV_UPPER = ("material_id", "plant_id", "storage_location", "unit_of_measure", SS)
INVENTORY = DatasetSpec(
    name="inventory",
    keys=(SS, "inventory_snapshot_date", "material_id", "plant_id", "storage_location"),
    record_id=RecordId("concat_keep_empty",
                       ("inventory_snapshot_date", "material_id", "plant_id", "storage_location"),
                       after_dedupe=True),
    trim=_INV_UPPER,
    null_tokens=(),
    upper=_INV_UPPER,
    present=("material_id", "plant_id", SS),
    not_null=("inventory_snapshot_date",),
    preserve_on_update=(CREATED,),  # D3 fix; parity: ()
    trusted_present=("material_id", "plant_id", SS),
    trusted_not_null=("inventory_snapshot_date",),
    references=(
        Reference("material", (SS, "material_id")),
        Reference("plant", (SS, "plant_id")),
    ),
    partition_by=("inventory_snapshot_date",),
)

SPECS: dict[str, DatasetSpec] = {
    s.name: s for s in (MATERIAL, PLANT, SUPPLIER, PURCHASE_ORDER, SHIPMENT, INVENTORY)
}

# Trusted publishing order (P14): masters, then facts after the tables they check.
TRUSTED_ORDER = ("material", "plant", "supplier", "purchase_order", "shipment", "inventory")


def spec(name: str) -> DatasetSpec:
    if name not in SPECS:
        raise ValueError(f"Unknown dataset: {name}. Expected one of {sorted(SPECS)}")
    return SPECS[name]


def parity(s: DatasetSpec) -> DatasetSpec:
    """The reference's behaviour where we fixed it on purpose (D3: shipment and
    inventory overwrite ``record_created_timestamp`` on every run)."""
    from dataclasses import replace

    if s.name in ("shipment", "inventory"):
        return replace(s, preserve_on_update=())
    return s
