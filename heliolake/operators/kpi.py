"""KPI long rows and small equipment documents.

KPI rows have the shape ``(Id, UpdateTimeUtc, Value)``. Every document becomes rows with
``inline``/``explode`` on the executors; documents are never gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliolake.functions.dates import parse_day

# KPI ids.
KPI_LIFETIME, KPI_LAST_YEAR, KPI_LAST_MONTH, KPI_LAST_DAY = 1, 2, 3, 4
KPI_POWER, KPI_ENERGY = 5, 6


def _kpi(id_: int, time, value):
    return F.struct(F.lit(id_).cast("bigint").alias("Id"),
                    time.cast("string").alias("UpdateTimeUtc"),
                    value.cast("double").alias("Value"))


def overview_kpis(overview: DataFrame) -> DataFrame:
    """Four rows per overview document (J1): lifetime / last-year / last-month / last-day
    energy, all stamped with ``lastUpdateTime``; a document without an overview (an error
    body) gives none."""
    overview = overview.filter("overview IS NOT NULL")
    o, t = "overview.", F.col("overview.lastUpdateTime")
    keep = [c for c in overview.columns if c != "overview"]
    return overview.select(*keep, F.inline(F.array(
        _kpi(KPI_LIFETIME, t, F.col(o + "lifeTimeData.energy")),
        _kpi(KPI_LAST_YEAR, t, F.col(o + "lastYearData.energy")),
        _kpi(KPI_LAST_MONTH, t, F.col(o + "lastMonthData.energy")),
        _kpi(KPI_LAST_DAY, t, F.col(o + "lastDayData.energy")),
    )))


def _series(df: DataFrame, field: str, id_: int) -> DataFrame:
    keep = [c for c in df.columns if c != field]
    pts = df.select(*keep, F.explode(f"{field}.values").alias("p"))
    return pts.select(*keep, F.lit(id_).cast("bigint").alias("Id"),
                      F.col("p.date").alias("UpdateTimeUtc"),
                      F.col("p.value").cast("double").alias("Value"))


def energy_series(energy: DataFrame) -> DataFrame:
    """Id 6 rows from ``energy.values[]``."""
    return _series(energy, "energy", KPI_ENERGY)


def power_series(power: DataFrame) -> DataFrame:
    """Id 5 rows from ``power.values[]``."""
    return _series(power, "power", KPI_POWER)


def kpi_table(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def data_period(df: DataFrame) -> DataFrame:
    """Start / end dates of a site's data (J4); a NULL or blank start makes both NULL, as
    does for itself a date that cannot be parsed."""
    s, e = F.col("dataPeriod.startDate"), F.col("dataPeriod.endDate")
    valid = s.isNotNull() & (F.trim(s) != "")
    keep = [c for c in df.columns if c != "dataPeriod"]
    return df.select(*keep,
                     F.when(valid, parse_day(s)).alias("start_date"),
                     F.when(valid, parse_day(e)).alias("end_date"))


def components(df: DataFrame) -> DataFrame:
    """One row per reporting component, keyed by its serial number."""
    keep = [c for c in df.columns if c != "reporters"]
    return (df.select(*keep, F.explode("reporters.list").alias("r"))
              .select(*keep, F.col("r.serialNumber").alias("serial_number"),
                      F.col("r.name").alias("name"), F.col("r.manufacturer").alias("manufacturer"),
                      F.col("r.model").alias("model")))
