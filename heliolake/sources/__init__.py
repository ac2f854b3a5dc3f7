"""Readers: bronze JSON landings and silver/gold Parquet tables."""

from heliolake.sources.bronze import (
    bronze_rejects,
    compact_landing,
    landed_partitions,
    read_compacted,
    read_components,
    read_data_period,
    read_energy,
    read_inventory_bronze,
    read_inverter_bronze,
    read_inverter_list,
    read_json_documents,
    read_overview,
    read_power,
    read_pretty_json,
    read_raw_landing,
    read_site_map,
    read_sites_bronze,
    merge_pages,
)
from heliolake.sources.tables import (
    day_filter,
    day_range_filter,
    read_table,
    read_table_range,
    repair_partitions,
)

__all__ = [
    "bronze_rejects", "landed_partitions", "read_json_documents",
    "read_components", "read_data_period", "read_energy", "read_inventory_bronze",
    "read_inverter_bronze", "read_inverter_list", "read_overview", "read_power",
    "read_pretty_json", "read_raw_landing", "read_site_map", "read_sites_bronze",
    "merge_pages", "day_filter", "day_range_filter", "read_table", "read_table_range",
    "repair_partitions",
]
