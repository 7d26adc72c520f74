import pytest

from stratum.contracts import all_contracts, contract
from stratum.sources.catalog import (assert_tables_exist, create_table_sql, create_tables, merge_into,
                                    missing_tables, preview)


def test_create_table_sql_has_not_null_and_comments():
    sql = create_table_sql(contract("material", "foundation"), "foundation.material")
    assert "`material_id` STRING NOT NULL" in sql and "COMMENT" in sql and "USING parquet" in sql
    assert "IF NOT EXISTS" in sql


def test_quotes_are_doubled():
    from dataclasses import replace
    c = replace(contract("plant", "raw"), comment="it's raw")
    assert "COMMENT 'it''s raw'" in create_table_sql(c, "raw.plant")


def test_create_tables_and_preview(spark, tmp_dir):
    names = create_tables(spark, all_contracts(), namespace_of=lambda c: f"t_{c.layer}", location_root=tmp_dir)
    assert len(names) == 18 and missing_tables(spark, names + ["t_raw.nope"]) == ["t_raw.nope"]
    assert_tables_exist(spark, names)
    with pytest.raises(ValueError, match=r"t_raw.nope.*t_raw.zz"):
        assert_tables_exist(spark, names + ["t_raw.zz", "t_raw.nope"])
    t = spark.table("t_foundation.inventory")
    assert t.columns == contract("inventory", "foundation").names
    # Spark keeps the columns but not NOT NULL on Parquet tables; publishing runs C6 instead
    assert all(f.nullable for f in t.schema.fields)
    assert preview(spark, t, "inv_preview", limit=5).count() == 0


def test_merge_into_is_rejected_on_parquet(spark, tmp_dir):
    create_tables(spark, [contract("material", "trusted")], namespace_of=lambda c: "m_trusted",
                  location_root=tmp_dir)
    src = spark.table("m_trusted.material")
    with pytest.raises(Exception):
        merge_into(src, "m_trusted.material", ["source_system", "material_id"])
    with pytest.raises(ValueError):
        merge_into(src, "m_trusted.material", [])
