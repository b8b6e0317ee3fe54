"""Typed I/O (O1), driver-table readers and domain adapters."""

from casebook.sources.io import load_table, save_table, save_as_table, conform, ensure_database
from casebook.sources.tables import read_table, TABLES

__all__ = ["load_table", "save_table", "save_as_table", "conform", "ensure_database", "read_table", "TABLES"]
