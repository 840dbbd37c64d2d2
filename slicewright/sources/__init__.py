"""Table sources: the catalog the slice jobs read and the test relations."""

from slicewright.sources.catalog import BASE_TABLES, Tables, fixture_tables, read_base

__all__ = ["BASE_TABLES", "Tables", "fixture_tables", "read_base"]
