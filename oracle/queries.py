"""DuckDB oracle SQL, one statement per registered query (same names, same columns)."""

from __future__ import annotations

from oracle.sql import (FND, INV_BATCH1_END, INV_BATCH2_START, PO_CUTOFF, PO_CUTOFF_0, RAW, RUN_TS, RUN_TS_0, RUN_TS_1, TRS,
                        fnd_inventory, fnd_material, fnd_po, nt, pres, raw_fnd, std_po, tr, trusted_ctes, up,
                        with_ctes)

DATE_COLS = {"order_date", "requested_delivery_date", "shipment_date", "actual_delivery_date",
             "inventory_snapshot_date"}
DECIMAL_COLS = {"order_quantity", "shipped_quantity", "received_quantity", "available_quantity",
                "blocked_quantity", "in_transit_quantity"}

COLUMNS = {
    "fnd.material": "material_id material_name material_type unit_of_measure product_group source_system "
                    "source_record_id record_created_timestamp record_updated_timestamp",
    "fnd.plant": "plant_id plant_name plant_type city state country source_system source_record_id "
                 "source_ingestion_timestamp record_created_timestamp record_updated_timestamp",
    "fnd.supplier": "supplier_id supplier_name supplier_type city state country source_system source_record_id "
                    "source_ingestion_timestamp record_created_timestamp record_updated_timestamp",
    "fnd.purchase_order": "purchase_order_id purchase_order_line material_id supplier_id plant_id order_date "
                          "requested_delivery_date order_quantity unit_of_measure order_status source_system "
                          "source_record_id source_ingestion_timestamp record_created_timestamp "
                          "record_updated_timestamp",
    "fnd.shipment": "shipment_id purchase_order_id purchase_order_line material_id supplier_id plant_id "
                    "shipment_date actual_delivery_date shipped_quantity received_quantity shipment_status "
                    "carrier_name transport_mode source_system source_record_id record_created_timestamp "
                    "record_updated_timestamp",
    "fnd.inventory": "inventory_snapshot_date material_id plant_id storage_location available_quantity "
                     "blocked_quantity in_transit_quantity unit_of_measure source_system source_record_id "
                     "record_created_timestamp record_updated_timestamp",
    "trs.material": "material_id material_name material_type unit_of_measure product_group source_system "
                    "record_created_timestamp record_updated_timestamp",
    "trs.plant": "plant_id plant_name plant_type city state country source_system record_created_timestamp "
                 "record_updated_timestamp",
    "trs.supplier": "supplier_id supplier_name supplier_type city state country source_system "
                    "record_created_timestamp record_updated_timestamp",
    "trs.purchase_order": "purchase_order_id purchase_order_line material_id supplier_id plant_id order_date "
                          "requested_delivery_date order_quantity unit_of_measure order_status source_system "
                          "record_created_timestamp record_updated_timestamp",
    "trs.shipment": "shipment_id purchase_order_id purchase_order_line material_id supplier_id plant_id "
                    "shipment_date actual_delivery_date shipped_quantity received_quantity shipment_status "
                    "carrier_name transport_mode source_system record_created_timestamp record_updated_timestamp",
    "trs.inventory": "inventory_snapshot_date material_id plant_id storage_location available_quantity "
                     "blocked_quantity in_transit_quantity unit_of_measure source_system "
                     "record_created_timestamp record_updated_timestamp",
    "raw.shipment": "shipment_id purchase_order_id purchase_order_line material_id supplier_id plant_id "
                    "shipment_date actual_delivery_date shipped_quantity received_quantity shipment_status "
                    "carrier_name transport_mode source_system source_file ingestion_batch_id ingestion_timestamp",
}

DATASETS = ("material", "plant", "supplier", "purchase_order", "shipment", "inventory")


def show(c: str, src: str | None = None) -> str:
    e = f"{src}.{c}" if src else c
    if c in DATE_COLS:
        return f"CAST({e} AS TIMESTAMP) AS {c}"
    if c in DECIMAL_COLS:
        return f"CAST({e} AS DOUBLE) AS {c}"
    return f"{e} AS {c}" if src else c


def select(names, rel: str, qual: str | None = None) -> str:
    """``SELECT <names shown for comparison> FROM <rel>``; ``qual`` qualifies the columns."""
    names = names.split() if isinstance(names, str) else names
    return f"SELECT {', '.join(show(c, qual) for c in names)} FROM {rel}"


def foundation_sql(d: str) -> str:
    return with_ctes(*raw_fnd([d])) + "\n" + select(COLUMNS[f"fnd.{d}"], f"fnd_{d}")


def trusted_sql(d: str) -> str:
    return with_ctes(*trusted_ctes(d)) + "\n" + select(COLUMNS[f"trs.{d}"], f"trs_{d}")


def _po_batch1_ctes() -> list[str]:
    return [RAW["purchase_order"],
            f"raw_po_b1 AS (SELECT * FROM raw_purchase_order WHERE ingestion_timestamp <= {PO_CUTOFF})",
            fnd_po("raw_po_b1", "po_b1", RUN_TS_1)]


def _upsert(keys, cols, target, source, keep=(), null_safe=True) -> str:
    op = "IS NOT DISTINCT FROM" if null_safe else "="
    cond = " AND ".join(f"t.{k} {op} s.{k}" for k in keys)
    exprs = []
    for c in cols:
        if c in keep:
            e = f"CASE WHEN t._in_t THEN t.{c} ELSE s.{c} END"
        else:
            e = f"CASE WHEN s._in_s THEN s.{c} ELSE t.{c} END"
        if c in DATE_COLS:
            e = f"CAST({e} AS TIMESTAMP)"
        elif c in DECIMAL_COLS:
            e = f"CAST({e} AS DOUBLE)"
        exprs.append(f"{e} AS {c}")
    return (f"SELECT {', '.join(exprs)} FROM (SELECT *, TRUE AS _in_t FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS _in_s FROM {source}) s ON {cond}")


PO_KEYS = ("source_system", "purchase_order_id", "purchase_order_line")
INV_KEYS = ("source_system", "inventory_snapshot_date", "material_id", "plant_id", "storage_location")
MAT_KEYS = ("source_system", "material_id")


def _inventory_batches() -> list[str]:
    return [RAW["inventory"],
            f"inv_b1 AS (SELECT * FROM raw_inventory WHERE ingestion_timestamp < {INV_BATCH1_END})",
            f"inv_b2 AS (SELECT * FROM raw_inventory WHERE ingestion_timestamp >= {INV_BATCH2_START})",
            fnd_inventory("inv_b1", "inv_t", RUN_TS_1),
            fnd_inventory("inv_b2", "inv_s", RUN_TS)]


def _renamed(cte: str, fnd: str, trs: str) -> str:
    """A Trusted CTE over other Foundation and Trusted names."""
    return cte.replace("trs_", "\0").replace("fnd_", fnd).replace("\0", trs)


_FIRST_FACTS = f"ingestion_timestamp <= {PO_CUTOFF}"
TWO_DELIVERIES = {d: [first, f"NOT ({first})"] for d, first in {
    "material": "ingestion_batch_id = 'fixture-1'", "plant": "TRUE", "supplier": "TRUE",
    "purchase_order": _FIRST_FACTS, "shipment": _FIRST_FACTS}.items()}
_FACTS = [f"ingestion_timestamp <= {PO_CUTOFF_0}", f"ingestion_timestamp > {PO_CUTOFF_0} AND ingestion_timestamp <= {PO_CUTOFF}",
          f"coalesce(ingestion_timestamp > {PO_CUTOFF}, TRUE)"]
_LATE = "coalesce(trim({}) LIKE '%{}', FALSE)"
THREE_DELIVERIES = {
    "material": [f"ingestion_batch_id = 'fixture-1' AND NOT {_LATE.format('material_id', 7)}", "ingestion_batch_id <> 'fixture-1'",
                 f"ingestion_batch_id = 'fixture-1' AND {_LATE.format('material_id', 7)}"],
    "plant": ["TRUE", "FALSE", "FALSE"],
    "supplier": [f"NOT {_LATE.format('supplier_id', 3)}", _LATE.format("supplier_id", 3), "FALSE"],
    "purchase_order": _FACTS, "shipment": _FACTS}
KEYS = {"material": MAT_KEYS, "plant": ("source_system", "plant_id"), "supplier": ("source_system", "supplier_id"),
        "purchase_order": PO_KEYS, "shipment": ("source_system", "shipment_id"), "inventory": INV_KEYS}


def _delivery_ctes(rows: dict[str, list[str]], runs: list[str], landed: bool = False) -> list[str]:
    """``landed``: rows of a delivery have one ingestion time and, for a key, one file.

    Foundation ``f<i>_`` and Trusted ``t<i>_`` after a publishing run for each delivery: Foundation merges the delivery,
    Trusted takes all of Foundation each time and keeps what it published before."""
    ctes = []
    for d, conditions in rows.items():
        cols, keys = COLUMNS[f"fnd.{d}"].split(), KEYS[d]
        ctes.append(RAW[d])
        for i, (condition, run) in enumerate(zip(conditions, runs, strict=True), 1):
            ctes += [f"raw{i}_{d} AS (SELECT *{_AT_ONCE.format(run) if landed else ''} FROM raw_{d} WHERE {condition})", FND[d](f"raw{i}_{d}", f"d{i}_{d}" if i > 1 else f"f1_{d}", run)]
            if i > 1:
                ctes.append(f"f{i}_{d} AS ({_upsert(keys, cols, f'f{i - 1}_{d}', f'd{i}_{d}', keep=('record_created_timestamp',))})")
    for i in range(1, len(runs) + 1):
        for d in rows:
            now = _renamed(TRS[d], f"f{i}_", f"t{i}_")
            if i > 1:
                match = " AND ".join(f"o.{k} IS NOT DISTINCT FROM n.{k}" for k in KEYS[d])
                ctes.append(now.replace(f"t{i}_{d} AS", f"n{i}_{d} AS", 1))
                now = (f"t{i}_{d} AS (SELECT * FROM n{i}_{d} UNION ALL BY NAME SELECT * FROM t{i - 1}_{d} o "
                       f"WHERE NOT EXISTS (SELECT 1 FROM n{i}_{d} n WHERE {match}))")
            ctes.append(now)
    return ctes


_AT_ONCE = " REPLACE ({} AS ingestion_timestamp, '' AS source_file)"


def _deliveries(rows: dict[str, list[str]], runs: list[str], landed: bool = False, wanted: str = "shipment") -> str:
    return with_ctes(*_delivery_ctes(rows, runs, landed)) + "\n" + select(COLUMNS[f"trs.{wanted}"], f"t{len(runs)}_{wanted}")


def _lacking(d: str, refs: str) -> list[str]:
    """(reason or null) of each reference of the Foundation row ``f``, in the Trusted tables named ``refs``."""
    out = [f"CASE WHEN NOT EXISTS (SELECT 1 FROM {refs}{ref} r WHERE r.source_system = f.source_system AND r.{idc} = f.{idc}) THEN 'no valid {ref}' END"
           for ref, idc in _refs().get(d, [])]
    if d == "shipment":
        out.append(f"CASE WHEN NOT (f.purchase_order_id IS NULL AND f.purchase_order_line IS NULL) AND NOT EXISTS (SELECT 1 FROM {refs}purchase_order r "
                   "WHERE r.source_system = f.source_system AND r.purchase_order_id = f.purchase_order_id "
                   "AND r.purchase_order_line = f.purchase_order_line) THEN 'no valid purchase_order' END")
    return out


# (not null and not empty, not null) of each layer; how the columns that Foundation asks for are cleaned; the record id
_IDS = ["material_id", "plant_id", "source_system"]
_SHIPMENT = ["shipment_id", "material_id", "supplier_id", "plant_id", "source_system"]
_PO = ["purchase_order_id", "purchase_order_line"]
ASKED = {
    "foundation": {"material": ([], ["material_id", "source_system"]), "plant": ([], ["plant_id", "source_system"]), "supplier": ([], ["supplier_id", "source_system"]),
                   "purchase_order": ([*_PO, "material_id", "supplier_id", "plant_id", "source_system"], []), "shipment": (_SHIPMENT, []),
                   "inventory": (_IDS, ["inventory_snapshot_date"])},
    "trusted": {"material": (["material_id", "material_name"], []), "plant": (["plant_id", "plant_name", "source_system"], []),
                "supplier": (["supplier_id", "supplier_name", "source_system"], []),
                "purchase_order": (_PO, ["material_id", "supplier_id", "plant_id", "source_system"]), "shipment": (_SHIPMENT, []),
                "inventory": (_IDS, ["inventory_snapshot_date"])}}
RECORD = {"material": "material_id", "plant": "plant_id", "supplier": "supplier_id", "purchase_order": "concat_ws('|', purchase_order_id, purchase_order_line)",
          "shipment": "shipment_id",
          "inventory": f"concat_ws('|', coalesce(CAST(inventory_snapshot_date AS VARCHAR), ''), coalesce({up('material_id')}, ''), coalesce({up('plant_id')}, ''), "
                       f"coalesce({up('storage_location')}, ''))"}


def _cleaned(d: str, c: str) -> str:
    if c in DATE_COLS:
        return c
    if c == "purchase_order_line":
        return tr(c)
    masters = ("material", "plant", "supplier")
    return f"upper({nt(tr(c))})" if d in masters and not (d == "material" and c == "source_system") else up(c)


def _rejected() -> str:
    parts = []
    for d in DATASETS:
        for layer in ("foundation", "trusted"):
            present, not_null = ASKED[layer][d]
            reasons = [f"CASE WHEN f.{c} IS NULL OR f.{c} = '' THEN '{c} missing' END" for c in present]
            reasons += [f"CASE WHEN f.{c} IS NULL THEN '{c} missing' END" for c in not_null]
            source = f"SELECT *, source_record_id AS record_id FROM fnd_{d}"
            if layer == "foundation":
                source = f"SELECT {RECORD[d]} AS record_id, {', '.join(f'{_cleaned(d, c)} AS {c}' for c in [*present, *not_null])} FROM raw_{d}"
            else:
                reasons += _lacking(d, "trs_")
            parts.append(f"SELECT '{layer}' AS layer, '{d}' AS dataset, record_id, reasons FROM (SELECT f.record_id, concat_ws(', ', {', '.join(reasons)}) AS reasons FROM ({source}) f) WHERE reasons <> ''")
    return with_ctes(*raw_fnd(DATASETS), *[TRS[d] for d in DATASETS]) + "\n" + "\nUNION ALL\n".join(parts)


def _waiting_rows() -> str:
    rows = {d: parts[:2] for d, parts in THREE_DELIVERIES.items()}
    parts = []
    for d in ("purchase_order", "shipment"):
        present, not_null = ASKED["trusted"][d]
        valid = " AND ".join([*(f"f.{c} IS NOT NULL AND f.{c} <> ''" for c in present), *(f"f.{c} IS NOT NULL" for c in not_null)])
        parts.append(f"SELECT '{d}' AS dataset, f.source_system, f.source_record_id, f.material_id, f.supplier_id, f.plant_id, f.record_updated_timestamp "
                     f"FROM f2_{d} f WHERE {valid} AND concat_ws('', {', '.join(_lacking(d, 't2_'))}) <> ''")
    return with_ctes(*_delivery_ctes(rows, [RUN_TS_0, RUN_TS_1])) + "\n" + "\nUNION ALL\n".join(parts)


def _refs():
    return {"purchase_order": [("material", "material_id"), ("supplier", "supplier_id"), ("plant", "plant_id")],
            "shipment": [("material", "material_id"), ("supplier", "supplier_id"), ("plant", "plant_id")],
            "inventory": [("material", "material_id"), ("plant", "plant_id")]}


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["trim_upper_keys"] = with_ctes(RAW["material"]) + f"""
SELECT material_id AS source_record_id,
       upper({nt(tr('material_id'))}) AS material_id,
       {nt(tr('material_name'))} AS material_name,
       upper({nt(tr('material_type'))}) AS material_type,
       upper({nt(tr('unit_of_measure'))}) AS unit_of_measure,
       {nt(tr('product_group'))} AS product_group,
       upper({tr('source_system')}) AS source_system,
       ingestion_timestamp
FROM raw_material"""

    q["lowercase_columns"] = with_ctes(RAW["supplier"]) + """
SELECT lower(supplier_id) AS supplier_id, lower(supplier_name) AS supplier_name, supplier_type,
       lower(state) AS state, country, lower(source_system) AS source_system
FROM raw_supplier"""

    q["nullify_empty"] = with_ctes(RAW["shipment"]) + """
SELECT shipment_id,
       CASE WHEN trim(purchase_order_id, ' ') = '' THEN NULL ELSE purchase_order_id END AS purchase_order_id,
       CASE WHEN trim(purchase_order_line, ' ') = '' THEN NULL ELSE purchase_order_line END AS purchase_order_line
FROM raw_shipment"""

    q["normalize_nulls"] = with_ctes(RAW["plant"]) + f"""
SELECT {nt('plant_id')} AS plant_id, {nt('plant_name')} AS plant_name, {nt('state')} AS state, country,
       {nt('source_system')} AS source_system
FROM raw_plant"""

    q["record_id_concat_skip_null"] = with_ctes(RAW["shipment"]) + """
SELECT shipment_id, concat_ws('|', purchase_order_id, purchase_order_line) AS po_record_id FROM raw_shipment"""

    q["record_id_concat_keep_empty"] = with_ctes(RAW["inventory"]) + f"""
SELECT material_id, plant_id, storage_location, ingestion_timestamp,
       concat_ws('|', coalesce(CAST(inventory_snapshot_date AS VARCHAR), ''), coalesce(material_id, ''),
                 coalesce(plant_id, ''), coalesce(storage_location, '')) AS source_record_id
FROM (SELECT inventory_snapshot_date, {up('material_id')} AS material_id, {up('plant_id')} AS plant_id,
             {up('storage_location')} AS storage_location, ingestion_timestamp FROM raw_inventory)"""

    po_std_cols = ("source_record_id purchase_order_id purchase_order_line material_id supplier_id plant_id "
                   "order_date requested_delivery_date order_quantity unit_of_measure order_status source_system "
                   "source_file ingestion_timestamp")
    q["required_columns_filter"] = with_ctes(RAW["purchase_order"]) + "\n" + select(
        po_std_cols, f"({std_po()}) x WHERE {pres('purchase_order_id', 'purchase_order_line', 'material_id', 'supplier_id', 'plant_id', 'source_system')}")

    q["latest_per_key"] = with_ctes(*raw_fnd(["purchase_order"])) + """
SELECT source_system, purchase_order_id, purchase_order_line, source_ingestion_timestamp AS ingestion_timestamp,
       material_id, supplier_id, CAST(order_quantity AS DOUBLE) AS order_quantity, source_record_id
FROM fnd_purchase_order"""

    q["high_water_mark"] = with_ctes(*_po_batch1_ctes()) + """
SELECT max(source_ingestion_timestamp) AS max_timestamp FROM po_b1"""

    raw_po_cols = ("purchase_order_id purchase_order_line material_id supplier_id plant_id order_date "
                   "requested_delivery_date order_quantity unit_of_measure order_status source_system source_file "
                   "ingestion_timestamp")
    q["incremental_filter"] = with_ctes(*_po_batch1_ctes()) + "\n" + select(
        raw_po_cols, "raw_purchase_order r WHERE (SELECT max(source_ingestion_timestamp) FROM po_b1) IS NULL "
                     "OR r.ingestion_timestamp > (SELECT max(source_ingestion_timestamp) FROM po_b1)")

    q["align_to_contract"] = """
WITH landing AS (
  SELECT CASE WHEN l_orderkey % 13 = 0 THEN 'abc' ELSE CAST(l_quantity AS VARCHAR) END AS shipped_quantity,
         'shp-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
         CASE WHEN l_orderkey % 11 = 0 THEN '2024-13-01' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END
           AS shipment_date,
         l_returnflag AS shipment_status, l_linestatus AS foo, 'sap' AS source_system,
         l_shipdate AS ingestion_timestamp
  FROM lineitem)
SELECT shipment_id, CAST(NULL AS VARCHAR) AS purchase_order_id, CAST(NULL AS VARCHAR) AS purchase_order_line,
       CAST(NULL AS VARCHAR) AS material_id, CAST(NULL AS VARCHAR) AS supplier_id, CAST(NULL AS VARCHAR) AS plant_id,
       CAST(TRY_CAST(shipment_date AS DATE) AS TIMESTAMP) AS shipment_date,
       CAST(NULL AS TIMESTAMP) AS actual_delivery_date,
       CAST(TRY_CAST(shipped_quantity AS DECIMAL(18,4)) AS DOUBLE) AS shipped_quantity,
       CAST(NULL AS DOUBLE) AS received_quantity, shipment_status,
       CAST(NULL AS VARCHAR) AS carrier_name, CAST(NULL AS VARCHAR) AS transport_mode, source_system,
       CAST(NULL AS VARCHAR) AS source_file, CAST(NULL AS VARCHAR) AS ingestion_batch_id,
       CAST(ingestion_timestamp AS TIMESTAMP) AS ingestion_timestamp
FROM landing"""

    q["ingestion_failed_casts"] = """
SELECT column_name, n AS failed_casts, n AS null_values
FROM (SELECT 'shipment_date' AS column_name, count(*) FILTER (WHERE l_orderkey % 11 = 0) AS n FROM lineitem
      UNION ALL SELECT 'shipped_quantity', count(*) FILTER (WHERE l_orderkey % 13 = 0) FROM lineitem)"""

    q["rescued_values"] = """
SELECT column_name, kind, value, count(*) AS rows
FROM (SELECT 'shipment_date' AS column_name, 'cast' AS kind, '2024-13-01' AS value FROM lineitem WHERE l_orderkey % 11 = 0
      UNION ALL SELECT 'shipped_quantity', 'cast', 'abc' FROM lineitem WHERE l_orderkey % 13 = 0
      UNION ALL SELECT 'foo', 'extra', l_linestatus FROM lineitem)
GROUP BY ALL"""

    q["distinct_keys"] = with_ctes(*raw_fnd(["purchase_order"])) + """
SELECT DISTINCT source_system, material_id FROM fnd_purchase_order"""

    q["ref_check_mandatory"] = with_ctes(*raw_fnd(["purchase_order", "material"]), TRS["material"]) + "\n" + select(
        COLUMNS["fnd.purchase_order"],
        "fnd_purchase_order f SEMI JOIN trs_material m ON f.source_system = m.source_system "
        "AND f.material_id = m.material_id", "f")

    q["ref_check_optional"] = with_ctes(*trusted_ctes("purchase_order"), *raw_fnd(["shipment"])) + "\n" + select(
        COLUMNS["fnd.shipment"],
        "fnd_shipment f WHERE (f.purchase_order_id IS NULL AND f.purchase_order_line IS NULL) OR EXISTS ("
        "SELECT 1 FROM trs_purchase_order p WHERE p.source_system = f.source_system "
        "AND p.purchase_order_id = f.purchase_order_id AND p.purchase_order_line = f.purchase_order_line)", "f")

    parts = []
    for d, refs in _refs().items():
        for ref, idc in refs:
            parts.append(f"SELECT '{d}' AS dataset, '{ref}' AS reference, count(*) AS rejected_rows "
                         f"FROM fnd_{d} f ANTI JOIN trs_{ref} r ON f.source_system = r.source_system "
                         f"AND f.{idc} = r.{idc}")
    q["reference_rejects"] = with_ctes(*raw_fnd(DATASETS), TRS["material"], TRS["supplier"], TRS["plant"]) + \
        "\n" + "\nUNION ALL\n".join(parts)

    parts = []
    for d, refs in _refs().items():
        for ref, idc in refs:
            parts.append(f"SELECT '{d}' AS dataset, '{ref}' AS reference, count(*) AS orphan_rows "
                         f"FROM trs_{d} f ANTI JOIN now_trs_{ref} r ON f.source_system = r.source_system "
                         f"AND f.{idc} = r.{idc}")
    parts.append("SELECT 'shipment' AS dataset, 'purchase_order' AS reference, count(*) AS orphan_rows "
                 "FROM trs_shipment f ANTI JOIN now_trs_purchase_order r ON f.source_system = r.source_system "
                 "AND f.purchase_order_id = r.purchase_order_id AND f.purchase_order_line = r.purchase_order_line "
                 "WHERE f.purchase_order_id IS NOT NULL")
    later = [f"now_raw_{d} AS (SELECT * REPLACE (CASE WHEN coalesce(trim({d}_id, ' ') LIKE '%7', FALSE) THEN NULL ELSE {d}_name END "
             f"AS {d}_name) FROM raw_{d})" for d in ("material", "plant", "supplier")]
    later += [FND[d](f"now_raw_{d}", f"now_fnd_{d}", RUN_TS) for d in ("material", "plant", "supplier")]
    later += [_renamed(TRS[d], "now_fnd_", "now_trs_") for d in ("material", "plant", "supplier")]
    later.append(_renamed(TRS["purchase_order"], "fnd_", "now_trs_"))
    q["published_audit"] = with_ctes(*raw_fnd(DATASETS), *[TRS[d] for d in DATASETS], *later) + "\n" + \
        "\nUNION ALL\n".join(parts)

    ctes, parts, lost_at = [*raw_fnd(["inventory"])], [], "TIMESTAMP '2024-01-15 00:00:00'"
    for d, system in (("material", up("source_system")), ("plant", f"upper({nt(tr('source_system'))})")):
        i, name = f"{d}_id", nt(tr(f"{d}_name"))
        ids = f"{system} AS source_system, upper({nt(tr(i))}) AS {i}"
        ctes += [RAW[d], f"every_{d} AS (SELECT {ids}, {name} AS name, coalesce(trim({i}, ' ') LIKE '%7', FALSE) AS lost, ingestion_timestamp AS t FROM raw_{d})",
                 f"some_{d} AS (SELECT * FROM every_{d} WHERE {i} IS NOT NULL AND source_system IS NOT NULL)",
                 f"last_{d} AS (SELECT * FROM some_{d} QUALIFY row_number() OVER (PARTITION BY source_system, {i} ORDER BY t DESC) = 1)",
                 f"v_{d} AS (SELECT source_system, {i}, t, {i} <> '' AND coalesce(name, '') <> '' AS valid FROM some_{d} UNION ALL "
                 f"SELECT source_system, {i}, {lost_at}, {i} <> '' AND NOT lost AND coalesce(name, '') <> '' FROM last_{d})",
                 f"now_{d} AS (SELECT * FROM v_{d} QUALIFY row_number() OVER (PARTITION BY source_system, {i} ORDER BY t DESC) = 1)"]
        parts.append(f"SELECT '{d}' AS reference, coalesce(v.valid, FALSE) AS valid_then, coalesce(n.valid, FALSE) AS valid_now, count(*) AS rows "
                     f"FROM fnd_inventory f ASOF LEFT JOIN v_{d} v ON v.source_system = f.source_system AND v.{i} = f.{i} AND v.t <= CAST(f.inventory_snapshot_date AS TIMESTAMP) "
                     f"LEFT JOIN now_{d} n ON n.source_system = f.source_system AND n.{i} = f.{i} GROUP BY ALL")
    q["reference_then_and_now"] = with_ctes(*ctes) + "\n" + "\nUNION ALL\n".join(parts)

    po_cols = COLUMNS["fnd.purchase_order"].split()
    q["upsert_two_batches"] = with_ctes(
        *_po_batch1_ctes(),
        "raw_po_b2 AS (SELECT * FROM raw_purchase_order WHERE (SELECT max(source_ingestion_timestamp) FROM po_b1) "
        "IS NULL OR ingestion_timestamp > (SELECT max(source_ingestion_timestamp) FROM po_b1))",
        fnd_po("raw_po_b2", "po_b2", RUN_TS)) + "\n" + _upsert(
        PO_KEYS, po_cols, "po_b1", "po_b2", keep=("record_created_timestamp",))

    mat_cols = COLUMNS["fnd.material"].split()
    q["upsert_preserve_created"] = with_ctes(
        RAW["material"],
        "raw_mat_b1 AS (SELECT * FROM raw_material WHERE ingestion_batch_id = 'fixture-1')",
        fnd_material("raw_mat_b1", "mat_t", RUN_TS_1),
        fnd_material("raw_material", "mat_s", RUN_TS)) + "\n" + _upsert(
        MAT_KEYS, mat_cols, "mat_t", "mat_s", keep=("record_created_timestamp",))

    inv_cols = COLUMNS["fnd.inventory"].split()
    q["upsert_null_key_safe"] = with_ctes(*_inventory_batches()) + "\n" + _upsert(
        INV_KEYS, inv_cols, "inv_t", "inv_s", keep=("record_created_timestamp",), null_safe=True)
    q["upsert_null_key_plain"] = with_ctes(*_inventory_batches()) + "\n" + _upsert(
        INV_KEYS, inv_cols, "inv_t", "inv_s", keep=(), null_safe=False)

    q["insert_only"] = with_ctes(*_po_batch1_ctes(), FND["purchase_order"]()) + "\n" + \
        select(po_cols, "po_b1") + "\nUNION ALL\n" + select(
            po_cols, "fnd_purchase_order s WHERE NOT EXISTS (SELECT 1 FROM po_b1 t WHERE "
                     "t.source_system = s.source_system AND t.purchase_order_id = s.purchase_order_id "
                     "AND t.purchase_order_line = s.purchase_order_line)")

    required = {
        "material": ["material_id", "source_system"],
        "plant": ["plant_id", "source_system"],
        "supplier": ["supplier_id", "source_system"],
        "purchase_order": ["purchase_order_id", "purchase_order_line", "material_id", "supplier_id", "plant_id",
                           "source_system"],
        "shipment": ["shipment_id", "material_id", "supplier_id", "plant_id", "source_system"],
        "inventory": ["inventory_snapshot_date", "material_id", "plant_id", "source_system"],
    }
    parts = [f"SELECT '{d}' AS dataset, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
             f"FROM raw_{d}" for d in DATASETS for c in required[d]]
    q["contract_conformance"] = with_ctes(*[RAW[d] for d in DATASETS]) + "\n" + "\nUNION ALL\n".join(parts)

    q["sql_preview"] = with_ctes(RAW["plant"]) + "\nSELECT * FROM raw_plant"

    q["ingest_available_now"] = """
SELECT event_id, ts, user_id, event_type, value, props, 'sap' AS source_system, 'events.parquet' AS source_file,
       'run-1' AS ingestion_batch_id, TRUE AS has_ingestion_timestamp
FROM events"""

    for d in DATASETS:
        q[f"foundation_{d}"] = foundation_sql(d)
        q[f"trusted_{d}"] = trusted_sql(d)
    q["streamed_latest_purchase_order"] = q["foundation_purchase_order"]
    # publishing from empty tables gives the same rows as the one-shot pipelines
    q["published_trusted_shipment"] = q["trusted_shipment"]
    q["published_bucketed_trusted_shipment"] = _deliveries(TWO_DELIVERIES, [RUN_TS_1, RUN_TS])
    q["landing_to_trusted"] = _deliveries(TWO_DELIVERIES, [RUN_TS_1, RUN_TS], landed=True)
    stock = {"material": TWO_DELIVERIES["material"], "plant": TWO_DELIVERIES["plant"],
             "inventory": [f"ingestion_timestamp < {INV_BATCH1_END}", f"ingestion_timestamp >= {INV_BATCH1_END}"]}
    q["landing_to_trusted_inventory"] = _deliveries(stock, [RUN_TS_1, RUN_TS], landed=True, wanted="inventory")
    q["rejected_rows"], q["waiting_rows"] = _rejected(), _waiting_rows()
    q["waiting_trusted_shipment"] = q["incremental_trusted_shipment"] = _deliveries(THREE_DELIVERIES, [RUN_TS_0, RUN_TS_1, RUN_TS])
    q["incremental_publish_purchase_order"] = q["upsert_two_batches"]
    return q


SQL = build()
