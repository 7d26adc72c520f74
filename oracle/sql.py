"""Independent DuckDB SQL for every registered query.

Written directly in SQL (QUALIFY, SEMI/ANTI JOIN, IS NOT DISTINCT FROM), not
generated from the Spark code, so the oracle checks the Spark operators
rather than repeating them.  The views ``part supplier nation region
lineitem orders customer events`` are the provided test tables.

Output convention shared with ``__spark_entry__.comparable``: DATE columns
are shown as TIMESTAMP and DECIMAL columns as DOUBLE so both engines hand the
comparison the same value types.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-06-30 00:00:00'"
RUN_TS_1 = "TIMESTAMP '2024-06-01 00:00:00'"
RUN_TS_0 = "TIMESTAMP '2024-05-01 00:00:00'"
PO_CUTOFF = "TIMESTAMP '1998-01-01 00:00:00'"
PO_CUTOFF_0 = "TIMESTAMP '1996-01-01 00:00:00'"
INV_BATCH1_END = "TIMESTAMP '2024-01-20 00:00:00'"
INV_BATCH2_START = "TIMESTAMP '2024-01-15 00:00:00'"

TOKENS = "('', 'NULL', 'null', 'N/A', 'NA')"


def tr(c: str) -> str:
    return f"trim({c}, ' ')"


def nt(e: str) -> str:
    return f"CASE WHEN trim({e}, ' ') IN {TOKENS} THEN NULL ELSE {e} END"


def up(c: str) -> str:
    return f"upper(trim({c}, ' '))"


def pres(*cols: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND {c} <> ''" for c in cols)


# --- Raw datasets -----------------------------------------------------------------

RAW_MATERIAL = """
raw_material AS (
  SELECT CASE WHEN p_partkey % 97 = 0 THEN 'N/A' WHEN p_partkey % 89 = 0 THEN ''
              ELSE '  mat-' || CAST(p_partkey AS VARCHAR) || ' ' END AS material_id,
         CASE WHEN p_partkey % 83 = 0 THEN 'NULL' ELSE p_name END AS material_name,
         lower(p_type) AS material_type, 'ea' AS unit_of_measure, p_brand AS product_group,
         'sap' AS source_system, 'part.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM part
  UNION ALL
  SELECT CASE WHEN p_partkey % 97 = 0 THEN 'N/A' WHEN p_partkey % 89 = 0 THEN ''
              ELSE '  mat-' || CAST(p_partkey AS VARCHAR) || ' ' END,
         CASE WHEN p_partkey % 83 = 0 THEN 'NULL' ELSE p_name || ' v2' END,
         lower(p_type), 'ea', p_brand,
         'sap', 'part.parquet', 'fixture-2', TIMESTAMP '2024-01-02 00:00:00'
  FROM part WHERE p_partkey % 10 = 0
)"""

RAW_SUPPLIER = """
raw_supplier AS (
  SELECT CASE WHEN s_suppkey % 23 = 5 THEN NULL ELSE ' sup-' || CAST(s_suppkey AS VARCHAR) END AS supplier_id,
         CASE WHEN s_suppkey % 17 = 3 THEN '' ELSE s_name END AS supplier_name,
         'tier' || CAST(s_suppkey % 3 AS VARCHAR) AS supplier_type,
         '  ' || lower(n_name) || ' ' AS city, n_name AS state, lower(r_name) AS country,
         'sap' AS source_system, 'supplier.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

RAW_PLANT = """
raw_plant AS (
  SELECT CASE WHEN n_nationkey = 7 THEN 'NA' ELSE 'plt-' || CAST(n_nationkey AS VARCHAR) END AS plant_id,
         CASE WHEN n_nationkey = 11 THEN ' ' ELSE n_name END AS plant_name,
         CASE WHEN n_nationkey % 2 = 0 THEN 'dc' ELSE 'mfg' END AS plant_type,
         lower(n_name) AS city,
         CASE WHEN n_regionkey = 0 THEN 'N/A' ELSE 'st-' || CAST(n_regionkey AS VARCHAR) END AS state,
         lower(r_name) AS country,
         'sap' AS source_system, 'nation.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_timestamp
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

RAW_PO = """
raw_purchase_order AS (
  SELECT ' po-' || CAST(l_orderkey AS VARCHAR) AS purchase_order_id,
         CAST(l_linenumber AS VARCHAR) AS purchase_order_line,
         'mat-' || CAST(l_partkey AS VARCHAR) || ' ' AS material_id,
         CASE WHEN l_orderkey % 50 = 0 THEN '' ELSE 'sup-' || CAST(l_suppkey AS VARCHAR) END AS supplier_id,
         'PLT-' || CAST(c_nationkey AS VARCHAR) AS plant_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS requested_delivery_date,
         CAST(l_quantity AS DECIMAL(18,4)) AS order_quantity,
         'ea' AS unit_of_measure, o_orderstatus AS order_status,
         'sap' AS source_system, 'lineitem.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         CAST(l_shipdate AS TIMESTAMP) AS ingestion_timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
)"""

RAW_SHIPMENT = """
raw_shipment AS (
  SELECT 'shp-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS shipment_id,
         CASE l_orderkey % 20 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 3 THEN 'po-none'
              ELSE ' po-' || CAST(l_orderkey AS VARCHAR) END AS purchase_order_id,
         CASE WHEN l_orderkey % 20 IN (0, 2) THEN NULL WHEN l_orderkey % 20 = 1 THEN ''
              ELSE CAST(l_linenumber AS VARCHAR) END AS purchase_order_line,
         'mat-' || CAST(l_partkey AS VARCHAR) AS material_id,
         'sup-' || CAST(l_suppkey AS VARCHAR) AS supplier_id,
         'plt-' || CAST(l_suppkey % 25 AS VARCHAR) AS plant_id,
         CAST(l_shipdate AS DATE) AS shipment_date,
         CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS actual_delivery_date,
         CAST(l_quantity AS DECIMAL(18,4)) AS shipped_quantity,
         CAST(l_quantity AS DECIMAL(18,4)) AS received_quantity,
         l_returnflag AS shipment_status,
         ' Carrier ' || CAST(l_suppkey % 7 AS VARCHAR) || ' ' AS carrier_name,
         CASE l_linenumber % 3 WHEN 0 THEN 'road' WHEN 1 THEN 'sea' ELSE 'air' END AS transport_mode,
         'sap' AS source_system, 'lineitem.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         CAST(l_shipdate AS TIMESTAMP) AS ingestion_timestamp
  FROM lineitem
)"""

RAW_INVENTORY = """
raw_inventory AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS inventory_snapshot_date,
         ' mat-' || CAST(event_id % 5 AS VARCHAR) AS material_id,
         'plt-' || CAST(user_id % 5 + 5 AS VARCHAR) AS plant_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS storage_location,
         CAST(value AS DECIMAL(18,4)) AS available_quantity,
         CAST(NULL AS DECIMAL(18,4)) AS blocked_quantity,
         CAST(user_id % 3 AS DECIMAL(18,4)) AS in_transit_quantity,
         'ea' AS unit_of_measure,
         'sap' AS source_system, 'events.parquet' AS source_file, 'fixture-1' AS ingestion_batch_id,
         CAST(ts AS TIMESTAMP) AS ingestion_timestamp
  FROM events
)"""

RAW = {
    "material": RAW_MATERIAL,
    "supplier": RAW_SUPPLIER,
    "plant": RAW_PLANT,
    "purchase_order": RAW_PO,
    "shipment": RAW_SHIPMENT,
    "inventory": RAW_INVENTORY,
}

# --- Foundation -------------------------------------------------------------------
# ``src`` is the raw relation to read, ``name`` the CTE name, ``ts`` the run time.


def fnd_material(src="raw_material", name="fnd_material", ts=RUN_TS) -> str:
    return f"""
{name} AS (
  SELECT material_id, material_name, material_type, unit_of_measure, product_group, source_system,
         source_record_id, {ts} AS record_created_timestamp, {ts} AS record_updated_timestamp
  FROM (
    SELECT material_id AS source_record_id,
           upper({nt(tr('material_id'))}) AS material_id,
           {nt(tr('material_name'))} AS material_name,
           upper({nt(tr('material_type'))}) AS material_type,
           upper({nt(tr('unit_of_measure'))}) AS unit_of_measure,
           {nt(tr('product_group'))} AS product_group,
           upper({tr('source_system')}) AS source_system,
           source_file, ingestion_timestamp
    FROM {src}
  )
  WHERE material_id IS NOT NULL AND source_system IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_system, material_id
      ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
               material_name DESC NULLS LAST, material_type DESC NULLS LAST,
               unit_of_measure DESC NULLS LAST, product_group DESC NULLS LAST) = 1
)"""


def _fnd_party(kind: str, src: str, name: str, ts: str) -> str:
    idc, namec, typec = f"{kind}_id", f"{kind}_name", f"{kind}_type"
    return f"""
{name} AS (
  SELECT {idc}, {namec}, {typec}, city, state, country, source_system, source_record_id,
         ingestion_timestamp AS source_ingestion_timestamp,
         {ts} AS record_created_timestamp, {ts} AS record_updated_timestamp
  FROM (
    SELECT {idc} AS source_record_id,
           upper({nt(tr(idc))}) AS {idc},
           {nt(tr(namec))} AS {namec},
           upper({nt(tr(typec))}) AS {typec},
           {nt(tr('city'))} AS city,
           {nt(tr('state'))} AS state,
           upper({nt(tr('country'))}) AS country,
           upper({nt(tr('source_system'))}) AS source_system,
           source_file, ingestion_timestamp
    FROM {src}
  )
  WHERE {idc} IS NOT NULL AND source_system IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY source_system, {idc}
      ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
               {namec} DESC NULLS LAST, {typec} DESC NULLS LAST, city DESC NULLS LAST,
               state DESC NULLS LAST, country DESC NULLS LAST) = 1
)"""


def fnd_plant(src="raw_plant", name="fnd_plant", ts=RUN_TS) -> str:
    return _fnd_party("plant", src, name, ts)


def fnd_supplier(src="raw_supplier", name="fnd_supplier", ts=RUN_TS) -> str:
    return _fnd_party("supplier", src, name, ts)


def std_po(src="raw_purchase_order") -> str:
    """Standardised purchase orders (record id before cleaning), not filtered."""
    return f"""
    SELECT concat_ws('|', purchase_order_id, purchase_order_line) AS source_record_id,
           {up('purchase_order_id')} AS purchase_order_id,
           {tr('purchase_order_line')} AS purchase_order_line,
           {up('material_id')} AS material_id,
           {up('supplier_id')} AS supplier_id,
           {up('plant_id')} AS plant_id,
           order_date, requested_delivery_date, order_quantity,
           {up('unit_of_measure')} AS unit_of_measure,
           {up('order_status')} AS order_status,
           {up('source_system')} AS source_system,
           source_file, ingestion_batch_id, ingestion_timestamp
    FROM {src}"""


PO_REQUIRED = pres("purchase_order_id", "purchase_order_line", "material_id", "supplier_id", "plant_id",
                   "source_system")
PO_ORDER = """ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
               material_id DESC NULLS LAST, supplier_id DESC NULLS LAST, plant_id DESC NULLS LAST,
               order_date DESC NULLS LAST, requested_delivery_date DESC NULLS LAST,
               order_quantity DESC NULLS LAST, unit_of_measure DESC NULLS LAST, order_status DESC NULLS LAST"""


def fnd_po(src="raw_purchase_order", name="fnd_purchase_order", ts=RUN_TS) -> str:
    return f"""
{name} AS (
  SELECT purchase_order_id, purchase_order_line, material_id, supplier_id, plant_id, order_date,
         requested_delivery_date, order_quantity, unit_of_measure, order_status, source_system,
         source_record_id, ingestion_timestamp AS source_ingestion_timestamp,
         {ts} AS record_created_timestamp, {ts} AS record_updated_timestamp
  FROM ({std_po(src)})
  WHERE {PO_REQUIRED}
  QUALIFY row_number() OVER (PARTITION BY source_system, purchase_order_id, purchase_order_line
      {PO_ORDER}) = 1
)"""


def fnd_shipment(src="raw_shipment", name="fnd_shipment", ts=RUN_TS) -> str:
    return f"""
{name} AS (
  SELECT shipment_id, purchase_order_id, purchase_order_line, material_id, supplier_id, plant_id,
         shipment_date, actual_delivery_date, shipped_quantity, received_quantity, shipment_status,
         carrier_name, transport_mode, source_system, source_record_id,
         {ts} AS record_created_timestamp, {ts} AS record_updated_timestamp
  FROM (
    SELECT shipment_id AS source_record_id,
           {up('shipment_id')} AS shipment_id,
           {up('purchase_order_id')} AS purchase_order_id,
           {tr('purchase_order_line')} AS purchase_order_line,
           {up('material_id')} AS material_id,
           {up('supplier_id')} AS supplier_id,
           {up('plant_id')} AS plant_id,
           shipment_date, actual_delivery_date, shipped_quantity, received_quantity,
           {up('shipment_status')} AS shipment_status,
           {tr('carrier_name')} AS carrier_name,
           {up('transport_mode')} AS transport_mode,
           {up('source_system')} AS source_system,
           source_file, ingestion_timestamp
    FROM {src}
  )
  WHERE {pres('shipment_id', 'material_id', 'supplier_id', 'plant_id', 'source_system')}
  QUALIFY row_number() OVER (PARTITION BY source_system, shipment_id
      ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
               purchase_order_id DESC NULLS LAST, purchase_order_line DESC NULLS LAST,
               material_id DESC NULLS LAST, supplier_id DESC NULLS LAST, plant_id DESC NULLS LAST,
               shipment_date DESC NULLS LAST, actual_delivery_date DESC NULLS LAST,
               shipped_quantity DESC NULLS LAST, received_quantity DESC NULLS LAST,
               shipment_status DESC NULLS LAST, carrier_name DESC NULLS LAST,
               transport_mode DESC NULLS LAST) = 1
)"""


def fnd_inventory(src="raw_inventory", name="fnd_inventory", ts=RUN_TS) -> str:
    return f"""
{name} AS (
  SELECT inventory_snapshot_date, material_id, plant_id, storage_location, available_quantity,
         blocked_quantity, in_transit_quantity, unit_of_measure, source_system,
         concat_ws('|', CAST(inventory_snapshot_date AS VARCHAR), material_id, plant_id,
                   coalesce(storage_location, '')) AS source_record_id,
         {ts} AS record_created_timestamp, {ts} AS record_updated_timestamp
  FROM (
    SELECT inventory_snapshot_date,
           {up('material_id')} AS material_id,
           {up('plant_id')} AS plant_id,
           {up('storage_location')} AS storage_location,
           available_quantity, blocked_quantity, in_transit_quantity,
           {up('unit_of_measure')} AS unit_of_measure,
           {up('source_system')} AS source_system,
           source_file, ingestion_timestamp
    FROM {src}
  )
  WHERE inventory_snapshot_date IS NOT NULL AND {pres('material_id', 'plant_id', 'source_system')}
  QUALIFY row_number() OVER (
      PARTITION BY source_system, inventory_snapshot_date, material_id, plant_id, storage_location
      ORDER BY ingestion_timestamp DESC NULLS LAST, source_file DESC NULLS LAST,
               available_quantity DESC NULLS LAST, blocked_quantity DESC NULLS LAST,
               in_transit_quantity DESC NULLS LAST, unit_of_measure DESC NULLS LAST) = 1
)"""


FND = {
    "material": fnd_material,
    "plant": fnd_plant,
    "supplier": fnd_supplier,
    "purchase_order": fnd_po,
    "shipment": fnd_shipment,
    "inventory": fnd_inventory,
}

# --- Trusted ----------------------------------------------------------------------

TRS_MATERIAL = f"""
trs_material AS (
  SELECT material_id, material_name, material_type, unit_of_measure, product_group, source_system,
         record_created_timestamp, record_updated_timestamp
  FROM fnd_material WHERE {pres('material_id', 'material_name')}
)"""

TRS_PLANT = f"""
trs_plant AS (
  SELECT plant_id, plant_name, plant_type, city, state, country, source_system,
         record_created_timestamp, record_updated_timestamp
  FROM fnd_plant WHERE {pres('plant_id', 'plant_name', 'source_system')}
)"""

TRS_SUPPLIER = f"""
trs_supplier AS (
  SELECT supplier_id, supplier_name, supplier_type, city, state, country, source_system,
         record_created_timestamp, record_updated_timestamp
  FROM fnd_supplier WHERE {pres('supplier_id', 'supplier_name', 'source_system')}
)"""

TRS_PO = f"""
trs_purchase_order AS (
  SELECT f.purchase_order_id, f.purchase_order_line, f.material_id, f.supplier_id, f.plant_id,
         f.order_date, f.requested_delivery_date, f.order_quantity, f.unit_of_measure, f.order_status,
         f.source_system, f.record_created_timestamp, f.record_updated_timestamp
  FROM fnd_purchase_order f
  SEMI JOIN trs_material m ON f.source_system = m.source_system AND f.material_id = m.material_id
  SEMI JOIN trs_supplier s ON f.source_system = s.source_system AND f.supplier_id = s.supplier_id
  SEMI JOIN trs_plant p ON f.source_system = p.source_system AND f.plant_id = p.plant_id
  WHERE {pres('f.purchase_order_id', 'f.purchase_order_line')}
    AND f.material_id IS NOT NULL AND f.supplier_id IS NOT NULL AND f.plant_id IS NOT NULL
    AND f.source_system IS NOT NULL
)"""

TRS_SHIPMENT = f"""
trs_shipment AS (
  SELECT f.shipment_id, f.purchase_order_id, f.purchase_order_line, f.material_id, f.supplier_id,
         f.plant_id, f.shipment_date, f.actual_delivery_date, f.shipped_quantity, f.received_quantity,
         f.shipment_status, f.carrier_name, f.transport_mode, f.source_system,
         f.record_created_timestamp, f.record_updated_timestamp
  FROM fnd_shipment f
  SEMI JOIN trs_material m ON f.source_system = m.source_system AND f.material_id = m.material_id
  SEMI JOIN trs_supplier s ON f.source_system = s.source_system AND f.supplier_id = s.supplier_id
  SEMI JOIN trs_plant p ON f.source_system = p.source_system AND f.plant_id = p.plant_id
  LEFT JOIN (SELECT DISTINCT source_system, purchase_order_id, purchase_order_line, TRUE AS hit
             FROM trs_purchase_order) po
    ON f.source_system = po.source_system AND f.purchase_order_id = po.purchase_order_id
   AND f.purchase_order_line = po.purchase_order_line
  WHERE {pres('f.shipment_id', 'f.material_id', 'f.supplier_id', 'f.plant_id', 'f.source_system')}
    AND ((f.purchase_order_id IS NULL AND f.purchase_order_line IS NULL) OR po.hit IS NOT NULL)
)"""

TRS_INVENTORY = f"""
trs_inventory AS (
  SELECT f.inventory_snapshot_date, f.material_id, f.plant_id, f.storage_location, f.available_quantity,
         f.blocked_quantity, f.in_transit_quantity, f.unit_of_measure, f.source_system,
         f.record_created_timestamp, f.record_updated_timestamp
  FROM fnd_inventory f
  SEMI JOIN trs_material m ON f.source_system = m.source_system AND f.material_id = m.material_id
  SEMI JOIN trs_plant p ON f.source_system = p.source_system AND f.plant_id = p.plant_id
  WHERE f.inventory_snapshot_date IS NOT NULL AND {pres('f.material_id', 'f.plant_id', 'f.source_system')}
)"""

TRS = {
    "material": TRS_MATERIAL,
    "plant": TRS_PLANT,
    "supplier": TRS_SUPPLIER,
    "purchase_order": TRS_PO,
    "shipment": TRS_SHIPMENT,
    "inventory": TRS_INVENTORY,
}

# CTE dependencies of each Trusted table.
TRS_NEEDS = {
    "material": ["material"],
    "plant": ["plant"],
    "supplier": ["supplier"],
    "purchase_order": ["material", "supplier", "plant", "purchase_order"],
    "shipment": ["material", "supplier", "plant", "purchase_order", "shipment"],
    "inventory": ["material", "plant", "inventory"],
}


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def raw_fnd(datasets) -> list[str]:
    out = []
    for d in datasets:
        out += [RAW[d], FND[d]()]
    return out


def trusted_ctes(dataset: str) -> list[str]:
    needs = TRS_NEEDS[dataset]
    return raw_fnd(needs) + [TRS[d] for d in needs]
