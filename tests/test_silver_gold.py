import pytest
from pyspark.sql import functions as F

import fixtures
from heliolake.operators import export, gold, silver
from heliolake.schemas import (AGG_KEYS, AGG_MEASURES, EXPORT_MEASURES, GOLD_INVERTER_COLUMNS,
                               SILVER_INVENTORY_COLUMNS, SILVER_INVERTER_COLUMNS,
                               SILVER_SITES_COLUMNS)
from heliolake.sources import (merge_pages, read_inventory_bronze, read_inverter_bronze,
                               read_sites_bronze)


@pytest.fixture(scope="module")
def bronze_root(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("bronze"))
    fixtures.write_all(root)
    return root


@pytest.fixture(scope="module")
def silver_inv(spark, bronze_root):
    return silver.flatten_telemetry(read_inverter_bronze(spark, bronze_root + "/inverters_data"))


def test_silver_columns_and_counts(silver_inv):
    assert silver_inv.columns == SILVER_INVERTER_COLUMNS + ["dt"]
    counts = {r["dt"]: r["count"] for r in silver_inv.groupBy("dt").count().collect()}
    assert counts == {fixtures.D1: 5, fixtures.D2: 2}


def test_ids_stay_strings(silver_inv):
    ids = {r[0] for r in silver_inv.select("Local_inverter_id").distinct().collect()}
    assert {"73E4", "AB12-5D", "H7", "S1"} <= ids
    assert dict(silver_inv.dtypes)["Local_inverter_id"] == "string"


def test_error_empty_null_bodies_dropped(silver_inv):
    ids = {r[0] for r in silver_inv.select("Local_inverter_id").distinct().collect()}
    assert not ({"0012", "X1", "ERR"} & ids)


def test_single_phase_nulls_and_power_factor(silver_inv):
    r = silver_inv.filter(F.col("Local_inverter_id") == "73E4").first()
    assert r["AC_Current"] is None and r["AC_Voltage"] is None and r["Reactive_Power"] is None
    assert r["Power_Factor"] == 1.0
    h = silver_inv.filter(F.col("Local_inverter_id") == "H7").first()
    assert h["Power_Factor"] == 0.91  # L1 cosPhi NULL -> L2
    assert h["AC_Current"] == pytest.approx((-0.5 + 205.0 + 300.0) / 3)
    assert h["Reactive_Power"] == pytest.approx(-2.0)
    for c in ("AC_Power", "DC_Current", "DC_Power", "Account_id"):
        assert h[c] is None


def test_whole_day_single_phase_no_failure(spark, bronze_root):
    day2 = silver.flatten_telemetry(
        read_inverter_bronze(spark, bronze_root + "/inverters_data", dt=fixtures.D2))
    assert day2.filter(F.col("Local_inverter_id") == "S1").first()["AC_Current_L3"] is None


def test_whole_and_fractional_power_same_type(silver_inv):
    assert dict(silver_inv.dtypes)["Active_Power"] == "double"
    vals = {r[0] for r in silver_inv.select("Active_Power").collect()}
    assert 4500.25 in vals and 5000.0 in vals


def test_gold_rules_and_source(silver_inv):
    g = gold.gold_inverters(silver_inv)
    assert g.columns == GOLD_INVERTER_COLUMNS + ["dt"]
    h = g.filter(F.col("Local_inverter_id") == "H7").first()
    assert h["AC_Current_L1"] == 0.0          # -0.5 in [-1, 0]
    assert h["AC_Current_L2"] == 200.0        # 205 in [200, 210]
    assert h["AC_Current_L3"] is None         # 300 > 210
    assert h["AC_Voltage_L2"] == 240.0        # 245 in [240, 250]
    assert h["AC_Voltage_L3"] is None         # 251 > 250
    assert h["Reactive_Power"] is None        # -2 < -1
    assert h["AC_Current"] == pytest.approx((-0.5 + 205.0 + 300.0) / 3)  # from silver mean
    assert h["Data_Source"] == "Solar Edge"
    a = g.filter(F.col("Local_inverter_id") == "AB12-5D").first()
    assert a["AC_Voltage_L1"] is None         # 230 V > 210 with the reference's limits


def test_agg_one_row_per_day(silver_inv):
    g = gold.gold_inverters(silver_inv)
    agg = gold.inverter_agg(g)
    assert set(agg.columns) == set(AGG_KEYS + ["dt"] + AGG_MEASURES)
    rows = agg.collect()
    assert len(rows) == 2
    d2 = [r for r in rows if r["dt"] == fixtures.D2][0]
    assert d2["Active_Power"] == pytest.approx((4500.25 + 1000.0) / 2)
    assert d2["AC_Power"] is None


def test_agg_with_custom_keys(silver_inv):
    g = gold.gold_inverters(silver_inv)
    agg = gold.inverter_agg(g, keys=["Local_site_id"], per_day=False)
    assert agg.count() == 3


def test_export_long(silver_inv):
    g = gold.gold_inverters(silver_inv)
    long = export.export_timeseries(g)
    assert long.count() == 18 * g.count()
    assert set(long.columns) == {"data_source", "local_site_id", "local_inverter_id", "time",
                                 "dt", "measure_name", "measure_value"}
    assert long.filter(F.col("measure_value").isNull()).count() == 0  # filled with 0
    names = {r[0] for r in long.select("measure_name").distinct().collect()}
    assert names == {m.lower() for m in EXPORT_MEASURES}
    t = long.filter((F.col("local_inverter_id") == "73E4")).select("time").first()[0]
    assert t == 1669892400000  # 2022-12-01 11:00:00 UTC


def test_export_rounding_half_up(spark):
    df = spark.createDataFrame([(1.0025, 2.0004999)], "a double, b double")
    out = export.melt_measures(df, [], ["a", "b"])
    got = {r["measure_name"]: r["measure_value"] for r in out.collect()}
    assert got == {"a": 1.003, "b": 2.0}


def test_inventory_and_sites(spark, bronze_root):
    inv = silver.flatten_inventory(read_inventory_bronze(spark, bronze_root + "/sites_invertory_details"))
    assert inv.columns == SILVER_INVENTORY_COLUMNS + ["dt"]
    assert inv.filter(F.col("dt") == fixtures.D1).count() == 6
    assert inv.filter(F.col("Id") == "73E4").first()["Manufacturer"] is None
    sites = silver.flatten_sites(read_sites_bronze(spark, bronze_root + "/sites_metadata"))
    assert sites.columns == SILVER_SITES_COLUMNS + ["dt"]
    assert sites.filter(F.col("dt") == fixtures.D1).count() == 143
    s1 = sites.filter((F.col("Id") == 1) & (F.col("dt") == fixtures.D1)).first()
    assert s1["Name"] == "אתר מזרחי" and s1["location_address2"] == "Hill 2"
    gs = gold.gold_sites(sites)
    r = gs.first()
    assert r["Latitude"] == 0 and r["Longitude"] == 0
    assert dict(gs.dtypes)["Latitude"] == "int"


def test_merge_pages(spark, bronze_root):
    pages = merge_pages(read_sites_bronze(spark, bronze_root + "/sites_metadata"))
    got = {r["dt"]: (r["announced"], r["received"], r["complete"]) for r in pages.collect()}
    assert got[fixtures.D1] == (143, 143, True)
    assert got[fixtures.D2] == (3, 2, False)
