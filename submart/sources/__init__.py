"""Sources (the SCD readers) and sinks (partition overwrite, table write)."""

from .readers import (drop_duplicate_rows, load, read_source, scd1_full,
                      scd1_window, scd4_active, scd4_asof, snapshot,
                      stored_rows)
from .sinks import conform, overwrite_partitions, read_table, write_table

__all__ = [
    "conform", "drop_duplicate_rows", "load", "overwrite_partitions",
    "read_source", "read_table", "scd1_full", "scd1_window", "scd4_active",
    "scd4_asof", "snapshot", "stored_rows", "write_table",
]
