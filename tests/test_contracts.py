from stratum.contracts import all_contracts, contract

# Foundation carry one more column on purpose (source_ingestion_timestamp, D2), and the
# purchase-order Foundation swaps source_updated_timestamp for it (D1), keeping 15.
COUNTS = {
    "material": (9, 9, 8),
    "plant": (10, 11, 9),
    "supplier": (10, 11, 9),
    "purchase_order": (14, 15, 13),
    "shipment": (17, 17, 16),
    "inventory": (12, 12, 11),
}


def test_column_counts():
    for d, (r, f, t) in COUNTS.items():
        assert (len(contract(d, "raw").columns), len(contract(d, "foundation").columns),
                len(contract(d, "trusted").columns)) == (r, f, t), d
    assert len(all_contracts()) == 18


def test_required_columns():
    assert contract("shipment", "foundation").required == [
        "shipment_id", "material_id", "supplier_id", "plant_id", "source_system",
        "record_created_timestamp", "record_updated_timestamp"]
    inv = contract("inventory", "trusted")
    assert inv.column("storage_location").nullable and not inv.column("inventory_snapshot_date").nullable
    assert contract("material", "raw").required == ["source_system", "ingestion_batch_id", "ingestion_timestamp"]
    po = contract("purchase_order", "foundation")
    assert "source_updated_timestamp" not in po.names and "source_ingestion_timestamp" in po.names
    assert "source_record_id" not in contract("purchase_order", "trusted").names


def test_unknown_names():
    import pytest
    with pytest.raises(ValueError):
        contract("nope", "raw")
    with pytest.raises(ValueError):
        contract("material", "gold")
