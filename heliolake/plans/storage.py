"""Driver queries that go through storage: data of the given tables is landed or written in
the shared folder, then read back by the readers, jobs and the stream of the library.

Each has a DuckDB twin in ``heliolake.plans.oracle_storage``.
"""

from __future__ import annotations

import datetime as _dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from heliolake import schemas
from heliolake.functions import dates as fd
from heliolake.functions.address import compose_address
from heliolake.functions.measures import epoch_millis
from heliolake.operators import incremental, kpi
from heliolake.operators import silver as silver_ops
from heliolake.operators.address import geocode_join, sites_csv_frame
from heliolake.plans import pipeline as P
from heliolake.plans.driver import (EVENTS_AS_OF, _customer_sites, _events_dt, _scratch,
                                    _supplier_lookup, inventory_bronze, sites_bronze, table)
from heliolake.sinks import (drop_previous_snapshot, land_bronze_json, spread_folders,
                             truncate_then_load, write_day, write_sites_csv)
from heliolake.sources import (bronze_rejects, landed_partitions, merge_pages,
                               read_inventory_bronze, read_inverter_bronze, read_inverter_list,
                               read_pretty_json, read_raw_landing, read_site_map,
                               read_sites_bronze, read_table)
from heliolake.sources.tables import register_table

# Days of the queries below.
DAY_1, DAY_2 = "2024-03-01", "2024-03-02"


def _day_of(key) -> F.Column:
    """Even keys land on the first day, odd ones on the second."""
    return F.when(F.col(key) % 2 == 0, F.lit(DAY_1)).otherwise(F.lit(DAY_2))


def supplier_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """One inverter-day document per supplier: site = nation, inverter = supplier."""
    phase = F.struct((F.col("s_acctbal") / 100).alias("acCurrent"),
                     (F.col("s_nationkey") * 10).cast("double").alias("acVoltage"))
    reading = F.struct(F.concat(_day_of("s_suppkey"), F.lit(" 10:00:00")).alias("date"),
                       F.col("s_acctbal").alias("totalEnergy"), phase.alias("L1Data"))
    return table(spark, sf, "supplier").select(
        F.struct(F.array(reading).alias("telemetries")).alias("data"),
        _day_of("s_suppkey").alias("dt"), F.col("s_nationkey").cast("string").alias("site_id"),
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("inv_id"))


def _layout(spark: SparkSession, name: str) -> P.Layout:
    root = _scratch(spark, name)
    return P.Layout(*[os.path.join(root, x) for x in ("bronze", "silver", "gold", "export",
                                                      "rejects")])


def _write_text(df: DataFrame, path: str, *keys: str) -> str:
    df.write.partitionBy(*keys).text(path)
    return path


def q_telemetry_path_ids(spark, sf):
    """K2 with its default folders, ids with leading zeros out of the path (S1), P1."""
    root = _scratch(spark, "telemetry")
    land_bronze_json(supplier_telemetry(spark, sf), root)
    return silver_ops.flatten_telemetry(read_inverter_bronze(spark, root)).select(
        "Local_site_id", "Local_inverter_id", "Datetime", "AC_Energy", "AC_Current_L1", "dt")


def q_inventory_from_landing(spark, sf):
    """Inventory documents landed by day and site, the site id read from the path."""
    root = _scratch(spark, "inventory")
    land_bronze_json(inventory_bronze(table(spark, sf, "part")), root, ("dt", "site_id"))
    return silver_ops.flatten_inventory(read_inventory_bronze(spark, root))


def q_sites_from_landing(spark, sf):
    """S3: site list pages landed by day."""
    root = _scratch(spark, "sites")
    land_bronze_json(sites_bronze(table(spark, sf, "supplier"), table(spark, sf, "nation"),
                                  table(spark, sf, "region")), root, ("dt",))
    return silver_ops.flatten_sites(read_sites_bronze(spark, root))


def q_events_one_day(spark, sf):
    """One day of a day-partitioned table."""
    path = _scratch(spark, "events")
    write_day(_events_dt(spark, sf).select("event_id", "user_id", "value", "dt"), path,
              distribute="rebalance")
    return read_table(spark, path, EVENTS_AS_OF)


def q_pretty_overviews(spark, sf):
    """S6 + J1: one indented overview document a file, one file per supplier."""
    e = lambda n: F.struct((F.col("s_acctbal") / n).alias("energy"))
    doc = F.struct(F.struct(F.lit(f"{DAY_1} 08:00:00").alias("lastUpdateTime"),
                            e(1).alias("lifeTimeData"), e(2).alias("lastYearData"),
                            e(4).alias("lastMonthData"), e(8).alias("lastDayData"))
                   .alias("overview"))
    docs = table(spark, sf, "supplier").select(
        F.to_json(doc, {"pretty": "true"}).alias("value"), F.col("s_suppkey").alias("site_id"))
    root = _write_text(spread_folders(docs, "site_id"), _scratch(spark, "pretty"), "site_id")
    schema = StructType([*schemas.OVERVIEW_BRONZE.fields, StructField("site_id", StringType())])
    return kpi.overview_kpis(read_pretty_json(spark, root, schema)).select(
        F.col("site_id").cast("bigint").alias("s_suppkey"), "Id", "UpdateTimeUtc", "Value")


def q_kpi_from_landing(spark, sf):
    """J1-J3 through the KPI job: overview documents as JSON Lines, energy and power series
    indented, several documents a file."""
    root, out = _scratch(spark, "kpi"), _scratch(spark, "kpi-out")
    orders = table(spark, sf, "orders").select(
        F.concat(F.year("o_orderdate").cast("string"), F.lit("-01-01")).alias("dt"),
        F.col("o_orderpriority").substr(1, 1).alias("site_id"),
        F.date_format("o_orderdate", fd.DATETIME_FORMAT).alias("t"), "o_totalprice")
    e = lambda n: F.struct((F.col("o_totalprice") / n).alias("energy"))
    overview = F.struct(F.col("t").alias("lastUpdateTime"), e(1).alias("lifeTimeData"),
                        e(2).alias("lastYearData"), e(4).alias("lastMonthData"),
                        e(8).alias("lastDayData"))
    keys = ("dt", "site_id")
    land_bronze_json(orders.select(overview.alias("overview"), *keys), f"{root}/overview", keys)
    for kind, factor in (("energy", 16), ("power", 32)):
        points = F.array(F.struct(F.col("t").alias("date"),
                                  (F.col("o_totalprice") / factor).alias("value")))
        doc = F.struct(F.struct(points.alias("values")).alias(kind))
        _write_text(orders.select(F.to_json(doc, {"pretty": "true"}).alias("value"), *keys)
                          .hint("rebalance", *keys), f"{root}/{kind}", *keys)
    P.run_kpis(spark, root, out)
    return spark.read.parquet(out)


def _reject_bodies(spark, sf) -> DataFrame:
    """Per customer one document: whole, truncated, an error code, or of another shape."""
    good = F.to_json(F.struct(F.struct(F.array(F.struct(
        F.col("c_acctbal").alias("totalEnergy"))).alias("telemetries")).alias("data")))
    body = (F.when(F.col("c_custkey") % 4 == 0, good)
             .when(F.col("c_custkey") % 4 == 1, F.substring(good, 1, 25))
             .when(F.col("c_custkey") % 4 == 2, F.lit('{"data": 403}'))
             .otherwise(F.lit('{"data": {"count": 0, "telemetries": []}}')))
    return table(spark, sf, "customer").select(
        body.alias("value"), F.lit(DAY_1).alias("dt"),
        F.col("c_nationkey").cast("string").alias("site_id"))


def q_bronze_rejects(spark, sf):
    """Truncated and error documents, per site and reason; empty lists are no rejects."""
    root = _write_text(_reject_bodies(spark, sf), _scratch(spark, "rejects"), "dt", "site_id")
    return (bronze_rejects(spark, root).groupBy("site_id", "reason")
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.length("body")).alias("shortest")))


def q_day_rerun_empty(spark, sf):
    """K1: both days run, then the first day's documents become error bodies and the range is
    run again: nothing of that day stays in silver, gold, aggregate or export."""
    lay = _layout(spark, "rerun")
    docs = supplier_telemetry(spark, sf)
    end = "2024-03-03"
    land_bronze_json(docs, lay.b(P.INVERTERS), ("dt", "site_id"))
    P.history_run(spark, lay, DAY_1, end, tables=(P.INVERTERS,))
    failed = docs.filter(F.col("dt") == DAY_1).withColumn("data", F.lit(500))
    land_bronze_json(failed, lay.b(P.INVERTERS), ("dt", "site_id"))
    P.history_run(spark, lay, DAY_1, end, tables=(P.INVERTERS,))
    parts = [spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("table"), "dt", "n")
             for name, path in (("silver", lay.s(P.INVERTERS)), ("gold", lay.g(P.INVERTERS)),
                                ("agg", lay.g(P.AGG)), ("export", lay.export))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_stream_refresh(spark, sf):
    """ST1: the stream refreshes all landed days; a file landed later is taken by the next run
    from the same checkpoint."""
    from heliolake.streaming import start_bronze_refresh
    lay, ckpt = _layout(spark, "stream"), _scratch(spark, "stream-ckpt")
    docs = supplier_telemetry(spark, sf)
    for day in (DAY_1, DAY_2):
        land_bronze_json(docs.filter(F.col("dt") == day), lay.b(P.INVERTERS), ("dt", "site_id"))
        start_bronze_refresh(spark, lay, ckpt).awaitTermination()
    return spark.read.parquet(lay.g(P.INVERTERS)).select(
        "Local_site_id", "Local_inverter_id", "Datetime", "AC_Energy", "AC_Current_L1",
        "AC_Voltage_L1", "dt")


def q_catalog_partitions(spark, sf):
    """A day written straight to storage is seen through the catalog after the repair."""
    path, name = _scratch(spark, "catalog"), f"hl_events_{uuid.uuid4().hex[:12]}"
    ev = _events_dt(spark, sf).select("event_id", "value", "dt")
    late = F.col("dt") >= EVENTS_AS_OF
    write_day(ev.filter(~late), path, distribute="rebalance")
    register_table(spark, name, path)
    write_day(ev.filter(late), path, distribute="rebalance")
    return (register_table(spark, name, path).groupBy("dt")
            .agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_event")))


def q_vendor_inverters(spark, sf):
    """Site map and inverter lists of the second vendor, the site out of the path."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    maps, lists = _scratch(spark, "site-map"), _scratch(spark, "inverter-list")
    n.select(F.array(F.struct(F.col("n_nationkey").cast("string").alias("key"),
                              F.col("n_name").alias("name"))).alias("data")).write.json(maps)
    land_bronze_json(s.select(
        F.array(F.struct(F.concat(F.lit("A"), "s_suppkey").alias("id")),
                F.struct(F.concat(F.lit("B"), "s_suppkey").alias("id"))).alias("data"),
        F.col("s_nationkey").cast("string").alias("site_id")), lists, ("site_id",))
    sites = read_site_map(spark, maps)
    found = read_inverter_list(spark, lists)
    return found.join(sites, found.site_id.cast("string") == sites.site_key).select(
        "site_key", "inverter_id")


def q_raw_landing(spark, sf):
    """One file per supplier, every seventh truncated, kept whole beside its path keys."""
    doc = F.to_json(F.struct("s_name", F.struct(F.col("s_acctbal").alias("v")).alias("m")))
    body = F.when(F.col("s_suppkey") % 7 == 0, F.substring(doc, 1, 9)).otherwise(doc)
    docs = table(spark, sf, "supplier").select(
        body.alias("value"), F.lit(DAY_1).alias("dt"), F.col("s_suppkey").alias("inv_id"))
    root = _write_text(spread_folders(docs, "dt", "inv_id"), _scratch(spark, "raw"), "dt", "inv_id")
    return read_raw_landing(spark, root).select(
        F.col("inv_id").cast("bigint").alias("s_suppkey"), "dt", "is_json",
        F.variant_get("doc", "$.m.v", "double").alias("v"))


def q_merged_pages(spark, sf):
    """Customers as pages of one nation-day's site list, announced against received."""
    day = F.date_format(F.date_add(F.lit(DAY_1).cast("date"), F.col("c_nationkey").cast("int")),
                        fd.DATE_FORMAT)
    site = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    sites = F.when(F.col("c_acctbal") >= 0, F.array(site)).otherwise(F.array(site, site))
    pages = table(spark, sf, "customer").select(
        F.struct((F.col("c_nationkey") + 60).cast("bigint").alias("count"),
                 sites.alias("site")).alias("sites"), day.alias("dt"))
    root = _scratch(spark, "pages")
    land_bronze_json(pages, root, ("dt",))
    return merge_pages(read_sites_bronze(spark, root))


def q_sites_csv(spark, sf):
    """K4: customers located by the lookup, as CSV with a header, read back as text."""
    sites = _customer_sites(spark, sf).select(
        F.concat(F.lit('site "'), "c_custkey", F.lit('", x')).alias("Name"),
        F.col("c_custkey").cast("double").alias("Peak_Power"),
        compose_address("address2", "address", "city").alias("query_address"))
    matched, _ = geocode_join(sites, _supplier_lookup(spark, sf))
    path = _scratch(spark, "csv")
    write_sites_csv(sites_csv_frame(matched), path)
    return (spark.read.option("header", "true").option("escape", '\\').csv(path)
            .select("name", F.col("peak power").cast("double").alias("peak_power"), "address",
                    F.col("latitude").cast("double").alias("latitude"),
                    F.col("longitude").cast("double").alias("longitude")))


def q_snapshot_retention(spark, sf):
    """K5: after the second day's snapshot, with other names, the first one goes."""
    path = _scratch(spark, "snapshot")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    write_day(c.withColumn("dt", F.lit(DAY_1)), path)
    write_day(c.select("c_custkey", F.upper(F.concat("c_name", F.lit(" b"))).alias("c_name"),
                       F.lit(DAY_2).alias("dt")), path)
    drop_previous_snapshot(spark, path, DAY_2)
    return spark.read.parquet(path)


def q_full_refresh(spark, sf):
    """K6: the second load, with other segment names, replaces the first entirely."""
    path = _scratch(spark, "refresh")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    truncate_then_load(c, path)
    truncate_then_load(c.withColumn("c_mktsegment", F.lower("c_mktsegment")), path)
    return spark.read.parquet(path)


def q_components(spark, sf):
    """Parts as reporters of one document per brand's part."""
    p = table(spark, sf, "part")
    item = F.struct(F.col("p_partkey").cast("string").alias("serialNumber"),
                    F.col("p_name").alias("name"), F.col("p_brand").alias("manufacturer"),
                    F.col("p_type").alias("model"))
    docs = p.select("p_size", F.struct(F.array(item).alias("list")).alias("reporters"))
    return kpi.components(docs)


def q_catch_up_from_landing(spark, sf):
    """C4 on landed folders: every supplier is expected on both days, each landed on one."""
    root = _scratch(spark, "landed")
    docs = supplier_telemetry(spark, sf)
    land_bronze_json(docs, root)
    sites = docs.select("site_id")
    inv = docs.select("site_id", F.col("inv_id").alias("inverter_id"))
    expected = incremental.work_list(sites, inv, DAY_1, "2024-03-03")
    landed = landed_partitions(spark, root).select(
        "site_id", F.col("inv_id").alias("inverter_id"), F.to_date("dt").alias("day"))
    out = incremental.missing_work(expected, landed)
    return out.withColumn("day", F.date_format("day", fd.DATE_FORMAT))


def q_stored_cursor(spark, sf):
    """C1 + C2 stored: events before a day make the first version; an update from the later
    ones, which for odd users carries no serial, is merged into it and stored over it."""
    path = _scratch(spark, "cursor")
    ev = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("site_id"), F.col("event_type").alias("serial_number"),
        F.to_date("ts").alias("last_date"), F.col("event_id").alias("seq"), "ts")
    early = F.col("ts") < F.lit(EVENTS_AS_OF).cast("timestamp")
    incremental.write_cursor(incremental.cursor_read(ev.filter(early).drop("ts")), path)
    new = ev.filter(~early).select(
        "site_id", F.when(F.col("site_id").cast("bigint") % 2 == 0, F.col("serial_number"))
                    .alias("serial_number"), "last_date", "seq")
    merged = incremental.cursor_upsert(incremental.read_cursor(spark, path), new,
                                       update_order="seq")
    incremental.write_cursor(merged, path)
    return incremental.cursor_read(incremental.read_cursor(spark, path)).select(
        F.col("site_id").cast("bigint").alias("user_id"), F.col("serial_number").alias("last_type"),
        F.date_format("last_date", fd.DATE_FORMAT).alias("last_date"))


def q_hourly_runs(spark, sf):
    """E1 with D2, D3 and C1-C3: a run late on the first day, one after midnight that closes
    it, one on the second day; the marker decides the days."""
    lay, cursor = _layout(spark, "hourly"), _scratch(spark, "hourly-cursor")
    land_bronze_json(supplier_telemetry(spark, sf), lay.b(P.INVERTERS), ("dt", "site_id"))
    incremental.write_cursor(incremental.run_marker(spark, _dt.datetime(2024, 3, 1, 22)), cursor)
    for now in (_dt.datetime(2024, 3, 1, 23), _dt.datetime(2024, 3, 2, 0, 10),
                _dt.datetime(2024, 3, 2, 1)):
        P.hourly_run(spark, lay, cursor, now, tables=(P.INVERTERS,))
    gold = spark.read.parquet(lay.g(P.INVERTERS))
    return gold.groupBy("dt", "Data_Source").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("AC_Energy"), 2).alias("energy"))


def q_tolerant_parsing(spark, sf):
    """D7, D8, P17 and J4 on readable, blank, short and foreign date strings: the unreadable
    ones give NULL and abort nothing."""
    good = F.date_format("o_orderdate", fd.DATETIME_FORMAT)
    turn = F.col("o_orderkey") % 5
    text = (F.when(turn == 0, good).when(turn == 1, F.lit(""))
             .when(turn == 2, F.substring(good, 1, 7)).when(turn == 3, F.lit("soon")))
    o = table(spark, sf, "orders").select("o_orderkey", text.alias("s"))
    y, m, d = fd.date_parts("s")
    period = kpi.data_period(o.select("o_orderkey", "s", F.struct(
        F.substring("s", 1, 10).alias("startDate"), F.lit("2031-02-30").alias("endDate"))
        .alias("dataPeriod")))
    return period.select(
        "o_orderkey", F.date_format(fd.parse_datetime("s"), fd.DATETIME_FORMAT).alias("parsed"),
        *[c.cast("string").alias(n) for n, c in
          (("time_ms", epoch_millis("s")), ("y", y), ("m", m), ("d", d))],
        F.date_format("start_date", fd.DATE_FORMAT).alias("start_date"),
        F.date_format("end_date", fd.DATE_FORMAT).alias("end_date"))


STORAGE_QUERIES = {
    "telemetry_path_ids": q_telemetry_path_ids,
    "inventory_from_landing": q_inventory_from_landing,
    "sites_from_landing": q_sites_from_landing,
    "events_one_day": q_events_one_day,
    "pretty_overviews": q_pretty_overviews,
    "kpi_from_landing": q_kpi_from_landing,
    "bronze_rejects": q_bronze_rejects,
    "day_rerun_empty": q_day_rerun_empty,
    "stream_refresh": q_stream_refresh,
    "catalog_partitions": q_catalog_partitions,
    "vendor_inverters": q_vendor_inverters,
    "raw_landing": q_raw_landing,
    "merged_pages": q_merged_pages,
    "sites_csv": q_sites_csv,
    "snapshot_retention": q_snapshot_retention,
    "full_refresh": q_full_refresh,
    "components": q_components,
    "catch_up_from_landing": q_catch_up_from_landing,
    "stored_cursor": q_stored_cursor,
    "hourly_runs": q_hourly_runs,
    "tolerant_parsing": q_tolerant_parsing,
}
