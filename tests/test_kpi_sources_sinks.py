import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

import fixtures
from heliolake.operators import address, kpi
from heliolake.sinks import land_bronze_json, truncate_then_load, write_day, write_sites_csv
from heliolake.sources import (read_components, read_data_period, read_energy,
                               read_inverter_bronze, read_inverter_list, read_overview,
                               read_power, read_raw_landing, read_site_map)

OVERVIEW = {"overview": {"lastUpdateTime": "2024-01-02 10:00:00",
                         "lifeTimeData": {"energy": 1000.0}, "lastYearData": {"energy": 100.0},
                         "lastMonthData": {"energy": 10.0}, "lastDayData": {"energy": 1.0}}}
ENERGY = {"energy": {"values": [{"date": "2024-01-02 00:00:00", "value": 5.0},
                                {"date": "2024-01-02 00:15:00", "value": None}]}}
POWER = {"power": {"values": [{"date": "2024-01-02 00:00:00", "value": 2.5}]}}


def _write(path, doc, pretty):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(json.dumps(doc, indent=4 if pretty else None) + "\n")


@pytest.mark.parametrize("pretty", [True, False])
def test_kpi_documents(spark, tmp_path, pretty):
    _write(f"{tmp_path}/o.json", OVERVIEW, pretty)
    _write(f"{tmp_path}/e.json", ENERGY, pretty)
    _write(f"{tmp_path}/p.json", POWER, pretty)
    o = kpi.overview_kpis(read_overview(spark, f"{tmp_path}/o.json", multi_line=pretty))
    rows = sorted((r["Id"], r["UpdateTimeUtc"], r["Value"]) for r in o.collect())
    assert rows == [(1, "2024-01-02 10:00:00", 1000.0), (2, "2024-01-02 10:00:00", 100.0),
                    (3, "2024-01-02 10:00:00", 10.0), (4, "2024-01-02 10:00:00", 1.0)]
    e = kpi.energy_series(read_energy(spark, f"{tmp_path}/e.json", multi_line=pretty))
    assert [(r["Id"], r["Value"]) for r in e.orderBy("UpdateTimeUtc").collect()] == \
        [(6, 5.0), (6, None)]
    p = kpi.power_series(read_power(spark, f"{tmp_path}/p.json", multi_line=pretty))
    allk = kpi.kpi_table(o, e, p)
    assert allk.count() == 7 and set(allk.columns) == {"Id", "UpdateTimeUtc", "Value"}


def test_data_period_and_components(spark, tmp_path):
    with open(f"{tmp_path}/dp.json", "w") as f:
        f.write(json.dumps({"dataPeriod": {"startDate": "2022-01-05", "endDate": "2024-01-01"}}) + "\n")
        f.write(json.dumps({"dataPeriod": {"startDate": None, "endDate": None}}) + "\n")
        f.write(json.dumps({"dataPeriod": {"startDate": " ", "endDate": "2024-01-01"}}) + "\n")
    got = [(r["start_date"], r["end_date"]) for r in
           kpi.data_period(read_data_period(spark, f"{tmp_path}/dp.json")).collect()]
    assert got == [(dt.date(2022, 1, 5), dt.date(2024, 1, 1)), (None, None), (None, None)]
    _write(f"{tmp_path}/c.json", {"reporters": {"count": 2, "list": [
        {"serialNumber": "7E1-AA", "name": "Inverter 1"}, {"serialNumber": "0012"}]}}, False)
    comps = kpi.components(read_components(spark, f"{tmp_path}/c.json"))
    assert [r["serial_number"] for r in comps.collect()] == ["7E1-AA", "0012"]


def test_second_vendor_lists(spark, tmp_path):
    _write(f"{tmp_path}/m.json", {"data": [{"key": "K1", "name": "a"}, {"key": "K2"}]}, True)
    assert [r[0] for r in read_site_map(spark, f"{tmp_path}/m.json", True).collect()] == ["K1", "K2"]
    _write(f"{tmp_path}/i.json", {"data": [{"id": "Id1"}, {"id": "0099"}]}, False)
    assert [r[0] for r in read_inverter_list(spark, f"{tmp_path}/i.json").collect()] == \
        ["Id1", "0099"]


def test_raw_landing(spark, tmp_path):
    _write(f"{tmp_path}/raw/a.json", {"measurements": {"x": [1, 2]}}, True)
    with open(f"{tmp_path}/raw/b.json", "w") as f:
        f.write("429")
    with open(f"{tmp_path}/raw/c.json", "w") as f:
        f.write("<html>error</html>")
    raw = read_raw_landing(spark, f"{tmp_path}/raw")
    got = {os.path.basename(r["source_file"]): r for r in raw.collect()}
    assert got["a.json"]["is_json"] and got["b.json"]["is_json"]
    assert not got["c.json"]["is_json"]
    x1 = raw.select(F.variant_get("doc", "$.measurements.x[1]", "int").alias("x1")) \
        .filter(F.col("x1").isNotNull()).collect()
    assert [r["x1"] for r in x1] == [2]


def test_compose_address(spark):
    df = spark.createDataFrame([("Hill 2", "Main", "Town"), (None, "Main", "Town"),
                                (None, None, "Town"), ("Hill 2", "", "Town"), (None, "", None)],
                               "a2 string, a string, c string")
    got = [r[0] for r in df.select(address.compose_address("a2", "a", "c")).collect()]
    assert got == ["Hill 2 Main Town", "Main Town", "Town", "Hill 2  Town", ""]


def test_geocode_join(spark):
    sites = spark.createDataFrame([(1, "Main Town"), (2, "Nowhere")], "id int, query_address string")
    lk = spark.createDataFrame([("Main Town", "1 Main St", 1.5, 2.5), ("Main Town", "dup", 0.0, 0.0)],
                               "query_address string, address string, latitude double, longitude double")
    m, r = address.geocode_join(sites, lk)
    assert m.count() == 1 and [x["id"] for x in r.collect()] == [2]


def test_land_bronze_and_read_back(spark, tmp_path):
    docs = spark.createDataFrame(
        [("2024-01-01", "101", "73E4", "2024-01-01 10:00:00", 1.0),
         ("2024-01-01", "101", "0012", "2024-01-01 10:00:00", 2.0)],
        "dt string, site_id string, inv_id string, date string, dcVoltage double")
    bronze = docs.select("dt", "site_id", "inv_id", F.struct(F.array(F.struct(
        "date", "dcVoltage")).alias("telemetries")).alias("data"))
    root = f"{tmp_path}/inverters_data"
    land_bronze_json(bronze, root)
    assert os.path.isdir(f"{root}/dt=2024-01-01/site_id=101/inv_id=0012")
    back = read_inverter_bronze(spark, root, dt="2024-01-01")
    ids = sorted(r["inv_id"] for r in back.collect())
    assert ids == ["0012", "73E4"]  # strings, not decimals


def test_write_day_dynamic_overwrite(spark, tmp_path):
    path = f"{tmp_path}/t"
    a = spark.createDataFrame([("d1", 1), ("d2", 2)], "dt string, v int")
    write_day(a, path)
    write_day(spark.createDataFrame([("d1", 9)], "dt string, v int"), path)
    got = sorted((r["dt"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [("d1", 9), ("d2", 2)]
    truncate_then_load(spark.createDataFrame([("d3", 3)], "dt string, v int"), path)
    assert [(r["dt"], r["v"]) for r in spark.read.parquet(path).collect()] == [("d3", 3)]
    with pytest.raises(ValueError):
        truncate_then_load(a, path, is_dimension=False)


def test_sites_csv(spark, tmp_path):
    df = spark.createDataFrame([("אתר", 300.0, "Ashkelon", 31.6, 34.5)],
                               "name string, `peak power` double, address string, "
                               "latitude double, longitude double")
    write_sites_csv(df, f"{tmp_path}/csv")
    back = spark.read.option("header", True).csv(f"{tmp_path}/csv")
    assert back.columns == ["name", "peak power", "address", "latitude", "longitude"]
    assert back.first()["name"] == "אתר"


def test_register_table_and_repair(spark, tmp_path):
    from heliolake.sources.tables import register_table
    path = f"{tmp_path}/tbl"
    write_day(spark.createDataFrame([("2024-01-01", 1)], "dt string, v int"), path)
    t = register_table(spark, "hl_reg_test", path)
    assert t.count() == 1
    write_day(spark.createDataFrame([("2024-01-02", 2)], "dt string, v int"), path)
    register_table(spark, "hl_reg_test", path)  # new day registered by repair
    spark.catalog.refreshTable("hl_reg_test")
    assert spark.table("hl_reg_test").count() == 2
    spark.sql("DROP TABLE hl_reg_test")


def test_sites_csv_legacy_charset(spark, tmp_path):
    import glob
    df = spark.createDataFrame([("אתר א", 1.0), ("Café ü", 2.0)], "name string, v double")
    write_sites_csv(df.coalesce(1), f"{tmp_path}/cp", encoding="windows-1255")
    raw = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{tmp_path}/cp/*.csv")))
    assert "אתר א".encode("cp1255") in raw
    assert b"Caf? ?" in raw  # unmappable characters replaced
