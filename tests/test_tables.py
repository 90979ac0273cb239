from __future__ import annotations

import pytest

from tradewind.tables import SOURCE_TABLES, SourceTable, source_table


def test_nine_tables_with_unique_names_and_files():
    assert len(SOURCE_TABLES) == 9
    assert len({t.name for t in SOURCE_TABLES}) == 9
    assert len({t.file for t in SOURCE_TABLES}) == 9


def test_merge_tables_have_keys_among_their_columns():
    for table in SOURCE_TABLES:
        assert (table.strategy == "merge") == bool(table.primary_key)
        assert set(table.primary_key) <= set(table.columns)


def test_merge_without_key_is_rejected():
    with pytest.raises(ValueError, match="primary key"):
        SourceTable("x", "x.csv", source_table("sellers").schema, "merge")


def test_unknown_table():
    with pytest.raises(KeyError, match="Unknown table"):
        source_table("nope")


def test_stored_schema_adds_lineage():
    names = source_table("sellers").stored_schema.fieldNames()
    assert names[-2:] == ["_source_file", "_loaded_at"]


def test_tables_without_usable_key_are_replaced():
    assert {t.name for t in SOURCE_TABLES if t.strategy == "full_refresh"} == {"geolocation", "order_reviews"}
