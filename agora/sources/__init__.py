"""Sources (CSV files, test-table mapping) and sinks (views, tables)."""

from agora.sources.csv import load_raw, read_loaded, read_raw_csv, read_raw_folder
from agora.sources.schemas import RAW_FILES, RAW_SCHEMAS
from agora.sources.testdata import raw_tables

__all__ = ["RAW_FILES", "RAW_SCHEMAS", "load_raw", "raw_tables",
           "read_loaded", "read_raw_csv", "read_raw_folder"]
