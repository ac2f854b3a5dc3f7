"""Writers and partition lifecycle (K1-K6)."""

from heliolake.sinks.day_table import ConcurrentCommit, DayTable
from heliolake.sinks.record_sink import read_records, write_records
from heliolake.sinks.writers import (
    drop_previous_snapshot,
    land_bronze_json,
    replace_day,
    spread_folders,
    truncate_then_load,
    write_day,
    write_sites_csv,
    write_window,
)

__all__ = ["ConcurrentCommit", "DayTable", "drop_previous_snapshot", "land_bronze_json",
           "read_records", "replace_day", "spread_folders", "truncate_then_load", "write_day",
           "write_records", "write_sites_csv", "write_window"]
