"""Sources and sinks: explicit-schema CSV/JSON readers and writers, and
idempotent table writes with verified row counts."""

from tallyspark.sources.files import read_csv, read_json, write_csv, write_json
from tallyspark.sources.tables import read_back_counts, write_table, write_tables

__all__ = ["read_back_counts", "read_csv", "read_json", "write_csv", "write_json",
           "write_table", "write_tables"]
