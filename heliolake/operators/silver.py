"""Bronze -> silver flattening.

Each document is exploded once on its struct array and the fields are read by name.
``explode`` (not ``explode_outer``) drops documents whose array is NULL or empty, which
covers error bodies (parsed as ``data = NULL``), ``telemetries: []`` and missing
``data`` alike (P4). All steps are narrow: no shuffle between the JSON scan and the
Parquet write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.functions.phase import phase_mean, phase_sum, power_factor, typed_null
from heliolake.schemas import (
    SILVER_INVENTORY_COLUMNS,
    SILVER_INVERTER_COLUMNS,
    SILVER_SITES_COLUMNS,
)


def _keep_dt(df: DataFrame) -> list[str]:
    return ["dt"] if "dt" in df.columns else []


def flatten_telemetry(bronze: DataFrame) -> DataFrame:
    """One row per telemetry reading with the silver column set."""
    extra = _keep_dt(bronze)
    t = (bronze
         .select(F.col("site_id").alias("Local_site_id"),
                 F.col("inv_id").alias("Local_inverter_id"),
                 *extra,
                 F.explode("data.telemetries").alias("t")))
    flat = t.select(
        "Local_site_id", "Local_inverter_id",
        F.col("t.date").alias("Datetime"),
        F.col("t.dcVoltage").alias("DC_Voltage"),
        F.col("t.temperature").alias("Temperature"),
        F.col("t.totalActivePower").alias("Active_Power"),
        F.col("t.totalEnergy").alias("AC_Energy"),
        F.col("t.L1Data.acCurrent").alias("AC_Current_L1"),
        F.col("t.L1Data.acVoltage").alias("AC_Voltage_L1"),
        F.col("t.L1Data.cosPhi").alias("L1Data_cosPhi"),
        F.col("t.L1Data.reactivePower").alias("L1Data_reactivePower"),
        F.col("t.L2Data.acCurrent").alias("AC_Current_L2"),
        F.col("t.L2Data.acVoltage").alias("AC_Voltage_L2"),
        F.col("t.L2Data.cosPhi").alias("L2Data_cosPhi"),
        F.col("t.L2Data.reactivePower").alias("L2Data_reactivePower"),
        F.col("t.L3Data.acCurrent").alias("AC_Current_L3"),
        F.col("t.L3Data.acVoltage").alias("AC_Voltage_L3"),
        F.col("t.L3Data.cosPhi").alias("L3Data_cosPhi"),
        F.col("t.L3Data.reactivePower").alias("L3Data_reactivePower"),
        *extra,
    )
    return derive_phases(flat).select(*SILVER_INVERTER_COLUMNS, *extra)


def derive_phases(flat: DataFrame) -> DataFrame:
    """Three-phase means / sum / power factor and the typed NULL columns."""
    return flat.select(
        "*",
        phase_mean("AC_Current_L1", "AC_Current_L2", "AC_Current_L3").alias("AC_Current"),
        phase_mean("AC_Voltage_L1", "AC_Voltage_L2", "AC_Voltage_L3").alias("AC_Voltage"),
        phase_sum("L1Data_reactivePower", "L2Data_reactivePower",
                  "L3Data_reactivePower").alias("Reactive_Power"),
        power_factor("L1Data_cosPhi", "L2Data_cosPhi", "L3Data_cosPhi").alias("Power_Factor"),
        typed_null("double").alias("AC_Power"),
        typed_null("double").alias("DC_Current"),
        typed_null("double").alias("DC_Power"),
        typed_null("string").alias("Account_id"),
    )


def flatten_inventory(bronze: DataFrame) -> DataFrame:
    """One row per inverter of a site's inventory."""
    extra = _keep_dt(bronze)
    inv = bronze.select(F.col("site_id").alias("Local_Parent_Id"), *extra,
                        F.explode("Inventory.inverters").alias("i"))
    return inv.select(
        "Local_Parent_Id",
        F.col("i.manufacturer").alias("Manufacturer"),
        F.col("i.model").alias("Model"),
        F.col("i.name").alias("Name"),
        F.col("i.SN").alias("Id"),
        *extra,
    ).select(*SILVER_INVENTORY_COLUMNS, *extra)


def flatten_sites(bronze: DataFrame) -> DataFrame:
    """One row per site of the site list, location flattened."""
    extra = _keep_dt(bronze)
    s = bronze.select(*extra, F.explode("sites.site").alias("s"))
    loc = "s.location."
    return s.select(
        F.col("s.accountId").alias("Account_id"),
        F.col("s.id").alias("Id"),
        F.col("s.installationDate").alias("Installation_Date"),
        F.col("s.name").alias("Name"),
        F.col("s.notes").alias("Comment"),
        F.col("s.peakPower").alias("Peak_Power"),
        F.col("s.status").alias("Status"),
        F.col("s.type").alias("Type"),
        F.col(loc + "address").alias("location_address"),
        F.col(loc + "address2").alias("location_address2"),
        F.col(loc + "city").alias("location_city"),
        F.col(loc + "country").alias("location_country"),
        F.col(loc + "countryCode").alias("location_countryCode"),
        F.col(loc + "timeZone").alias("location_timeZone"),
        F.col(loc + "zip").alias("location_zip"),
        *extra,
    ).select(*SILVER_SITES_COLUMNS, *extra)
