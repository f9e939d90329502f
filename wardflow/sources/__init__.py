"""Readers, writers and schemas of the clinical tables."""

from wardflow.sources.tables import SCHEMAS, ParquetTables, Tables, stage_tables

__all__ = ["SCHEMAS", "ParquetTables", "Tables", "stage_tables"]
