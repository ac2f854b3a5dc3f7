"""Explicit schemas for every bronze document and every silver / gold table.

Bronze JSON is never read with schema inference: inference needs an extra pass over all
files, fails when a struct (``L3Data``) is absent from a whole day, flips whole-number
doubles to ``bigint`` and turns error bodies (a bare status code) into ``_corrupt_record``.
With these schemas an error body simply parses to ``data = NULL`` and produces no rows.
Only the fields the jobs read are declared, so the JSON reader skips the rest.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, D, L = StringType(), DoubleType(), LongType()


def _struct(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# ---------------------------------------------------------------------------- bronze
PHASE = _struct(("acCurrent", D), ("acVoltage", D), ("cosPhi", D), ("reactivePower", D))

TELEMETRY = _struct(
    ("date", S),
    ("dcVoltage", D),
    ("temperature", D),
    ("totalActivePower", D),
    ("totalEnergy", D),
    ("L1Data", PHASE),
    ("L2Data", PHASE),
    ("L3Data", PHASE),
)

# inverters_data/dt=/site_id=/inv_id=/*.json  (site_id, inv_id, dt come from the path)
INVERTER_BRONZE = _struct(
    ("data", _struct(("telemetries", ArrayType(TELEMETRY, True)))),
    ("dt", S),
    ("site_id", S),
    ("inv_id", S),
)

INVENTORY_ITEM = _struct(("manufacturer", S), ("model", S), ("name", S), ("SN", S))

# sites_invertory_details/dt=/site_id=/*.json
INVENTORY_BRONZE = _struct(
    ("Inventory", _struct(("inverters", ArrayType(INVENTORY_ITEM, True)))),
    ("dt", S),
    ("site_id", S),
)

LOCATION = _struct(
    ("address", S), ("address2", S), ("city", S), ("country", S),
    ("countryCode", S), ("timeZone", S), ("zip", S),
)

SITE = _struct(
    ("accountId", L), ("id", L), ("installationDate", S), ("name", S), ("notes", S),
    ("peakPower", D), ("status", S), ("type", S), ("location", LOCATION),
    ("publicSettings", _struct(("isPublic", BooleanType()))),
)

# sites_metadata/dt=/*.json  (one document per page of the site list)
SITES_BRONZE = _struct(
    ("sites", _struct(("count", L), ("site", ArrayType(SITE, True)))),
    ("dt", S),
)

# KPI documents (second vendor) and equipment documents
ENERGY_VALUE = _struct(("energy", D))
OVERVIEW_BRONZE = _struct(
    ("overview", _struct(
        ("lastUpdateTime", S),
        ("lifeTimeData", ENERGY_VALUE),
        ("lastYearData", ENERGY_VALUE),
        ("lastMonthData", ENERGY_VALUE),
        ("lastDayData", ENERGY_VALUE),
    )),
)
SERIES_POINT = _struct(("date", S), ("value", D))
ENERGY_BRONZE = _struct(("energy", _struct(("values", ArrayType(SERIES_POINT, True)))))
POWER_BRONZE = _struct(("power", _struct(("values", ArrayType(SERIES_POINT, True)))))
DATA_PERIOD_BRONZE = _struct(("dataPeriod", _struct(("startDate", S), ("endDate", S))))
COMPONENTS_BRONZE = _struct(
    ("reporters", _struct(("list", ArrayType(_struct(("serialNumber", S), ("name", S),
                                                     ("manufacturer", S), ("model", S)), True)))),
)
SITE_MAP_BRONZE = _struct(("data", ArrayType(_struct(("key", S), ("name", S)), True)))
INVERTER_LIST_BRONZE = _struct(("data", ArrayType(_struct(("id", S), ("name", S)), True)))

# ---------------------------------------------------------------------------- silver
# Output column names and order of the silver / gold tables.
SILVER_INVERTER_COLUMNS = [
    "Local_site_id", "Local_inverter_id", "Datetime", "DC_Voltage", "Temperature",
    "Active_Power", "AC_Energy", "AC_Current_L1", "AC_Voltage_L1", "L1Data_cosPhi",
    "L1Data_reactivePower", "AC_Current_L2", "AC_Voltage_L2", "L2Data_cosPhi",
    "L2Data_reactivePower", "AC_Current_L3", "AC_Voltage_L3", "L3Data_cosPhi",
    "L3Data_reactivePower", "AC_Current", "AC_Voltage", "Reactive_Power", "Power_Factor",
    "AC_Power", "DC_Current", "DC_Power", "Account_id",
]

SILVER_INVENTORY_COLUMNS = ["Local_Parent_Id", "Manufacturer", "Model", "Name", "Id"]

SILVER_SITES_COLUMNS = [
    "Account_id", "Id", "Installation_Date", "Name", "Comment", "Peak_Power", "Status",
    "Type", "location_address", "location_address2", "location_city", "location_country",
    "location_countryCode", "location_timeZone", "location_zip",
]

# ---------------------------------------------------------------------------- gold
# Output column names and order.
GOLD_INVERTER_COLUMNS = [
    "Datetime", "Local_site_id", "Local_inverter_id", "AC_Voltage", "AC_Power", "AC_Energy",
    "DC_Voltage", "Power_Factor", "Active_Power", "Temperature", "DC_Current", "DC_Power",
    "Account_id", "AC_Current_L1", "AC_Current_L2", "AC_Current_L3", "AC_Voltage_L1",
    "AC_Voltage_L2", "AC_Voltage_L3", "AC_Current", "Reactive_Power", "Data_Source",
]

AGG_KEYS = ["Account_id", "Data_Source", "DC_Current"]
AGG_MEASURES = [
    "AC_Voltage", "AC_Power", "AC_Energy", "DC_Voltage", "Power_Factor", "Active_Power",
    "Temperature", "DC_Power", "AC_Current_L1", "AC_Current_L2", "AC_Current_L3",
    "AC_Voltage_L1", "AC_Voltage_L2", "AC_Voltage_L3", "AC_Current", "Reactive_Power",
]

GOLD_SITES_COLUMNS = [
    "Id", "Name", "Status", "Peak_Power", "Installation_Date", "Comment", "Type",
    "Account_id", "Latitude", "Longitude",
]

# Measures of the long time-series export, in record order.
EXPORT_MEASURES = [
    "DC_Voltage", "Temperature", "Active_Power", "AC_Energy", "AC_Current_L1",
    "AC_Voltage_L1", "AC_Current_L2", "AC_Voltage_L2", "AC_Current_L3", "AC_Voltage_L3",
    "AC_Current", "AC_Voltage", "Reactive_Power", "Power_Factor", "AC_Power",
    "DC_Current", "DC_Power", "Account_id",
]
EXPORT_DIMENSIONS = ["data_source", "local_site_id", "local_inverter_id"]


def _stored(columns: list[str]) -> StructType:
    """Stored types of an inverter table: ids, times and labels are text, the rest doubles."""
    text = {"Local_site_id", "Local_inverter_id", "Datetime", "Account_id", "Data_Source"}
    return _struct(*[(c, S if c in text else D) for c in columns], ("dt", S))


SILVER_INVERTERS = _stored(SILVER_INVERTER_COLUMNS)
GOLD_INVERTERS = _stored(GOLD_INVERTER_COLUMNS)

# ---------------------------------------------------------------------------- bookkeeping
CURSOR = StructType([
    StructField("site_id", S, False),
    StructField("serial_number", S, True),
    StructField("last_date", DateType(), True),
    StructField("seq", L, True),
    StructField("moment", TimestampType(), True),
])
