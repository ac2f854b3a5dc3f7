"""The library's operators run on the driver's generated tables (TPC-H-like + events).

Two kinds of queries live here:

* **Pipeline on a telemetry view.** ``telemetry_bronze(lineitem)`` shapes every line item
  as one bronze telemetry document (``data.telemetries`` with one reading, ids and ``dt``
  beside it) using only per-row expressions, no grouping. The real silver, gold,
  aggregate and export operators then run on it, so the whole pipeline scales with the
  ``lineitem`` table.
* **Operator probes.** One query per operator family on the table that suits it
  (``events`` for rules, days and cursors, ``orders`` for dates and duplicates, ...).

Each query has a DuckDB SQL twin in ``ORACLE_SQL`` with the same column names.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heliolake.functions import dates as fd
from heliolake.functions.address import compose_address
from heliolake.functions.measures import epoch_millis
from heliolake.functions.phase import phase_mean, phase_sum, power_factor, typed_null
from heliolake.functions.rules import RangeRule
from heliolake.operators import export as export_ops
from heliolake.operators import gold as gold_ops
from heliolake.operators import incremental, kpi, quality
from heliolake.operators import silver as silver_ops
from heliolake.operators.address import geocode_join
from heliolake.schemas import AGG_MEASURES, GOLD_INVERTER_COLUMNS
from heliolake.sources.tables import DayOf, day_range_filter

# Parameters of the driver queries.
EVENTS_RULE = RangeRule("value", lo_null=20, zero_upper=30, hi_null=200, cap=150)
EVENTS_AS_OF = "2024-01-21"
RANGE_START, RANGE_END = "2024-01-10", "2024-01-20"
CATCH_UP_AS_OF = "2024-01-31"
WORK_START, WORK_END = "2024-01-01", "2024-01-08"
GOLD_RANGE_START, GOLD_RANGE_END = "1996-01-01", "1997-01-01"
SNAPSHOT_DAY = "1998-06-01"
CHECKS_AS_OF = "1998-06-02"
ROUND_AVG = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _iso(df: DataFrame, *cols: str) -> DataFrame:
    """Days leave the probes as ISO strings, like the ``dt`` partition values."""
    return df.select(*[F.date_format(c, fd.DATE_FORMAT).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ----------------------------------------------------------------------------------
# telemetry view of lineitem (bronze shape) and the pipeline on it
# ----------------------------------------------------------------------------------
def telemetry_bronze(lineitem: DataFrame) -> DataFrame:
    """One bronze telemetry document per line item.

    site = supplier, inverter = part, reading time = ship date + 15 min x line number;
    phase values are affine maps of quantity / discount / tax chosen to cross every
    branch of the gold range rules. Line 1 is single-phase (no L3Data); line 7 carries
    an error body (``data = NULL``), which the silver explode drops.
    """
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    ts = F.col("l_shipdate").cast("timestamp") + \
        F.make_interval(mins=F.col("l_linenumber") * F.lit(15))

    def phase(cur, volt, cos, react):
        return F.struct(cur.alias("acCurrent"), volt.alias("acVoltage"),
                        cos.alias("cosPhi"), react.alias("reactivePower"))

    l1 = phase(q * 5 - 20, q + 180, F.when(d != 0, 1 - d), t * 100 - 2)
    l2 = phase(q * 4.5 - 5, q + 200, 1 - t, d * 100 - 1.5)
    l3 = F.when(F.col("l_linenumber") > 1,
                phase(q * 5.5 - 30, q + 205, F.lit(0.9), t * 10))
    reading = F.struct(
        F.date_format(ts, fd.DATETIME_FORMAT).alias("date"),
        (F.col("l_extendedprice") / q).alias("dcVoltage"),
        (t * 500).alias("temperature"),
        (q * 100).alias("totalActivePower"),
        F.col("l_extendedprice").alias("totalEnergy"),
        l1.alias("L1Data"), l2.alias("L2Data"), l3.alias("L3Data"))
    data = F.struct(F.array(reading).alias("telemetries"))
    return lineitem.select(
        data.alias("data"),
        F.date_format(F.col("l_shipdate"), fd.DATE_FORMAT).alias("dt"),
        F.col("l_suppkey").cast("string").alias("site_id"),
        F.col("l_partkey").cast("string").alias("inv_id"))


def q_silver_inverters(spark, sf):
    return silver_ops.flatten_telemetry(telemetry_bronze(table(spark, sf, "lineitem")))


def q_silver_error_bodies(spark, sf):
    """Error bodies (NULL data) and empty reading lists beside every document drop out."""
    docs = telemetry_bronze(table(spark, sf, "lineitem"))
    kind = docs.schema["data"].dataType
    empty = F.struct(F.array().cast(kind["telemetries"].dataType).alias("telemetries"))
    return silver_ops.flatten_telemetry(
        docs.unionByName(docs.withColumn("data", F.lit(None).cast(kind)))
            .unionByName(docs.withColumn("data", empty)))


def q_gold_inverters(spark, sf):
    return gold_ops.gold_inverters(q_silver_inverters(spark, sf))


def q_gold_agg(spark, sf):
    agg = gold_ops.inverter_agg(q_gold_inverters(spark, sf))
    return agg.select(*[F.round(c, ROUND_AVG).alias(c) if c in AGG_MEASURES else F.col(c)
                        for c in agg.columns])


def q_export_long(spark, sf):
    return export_ops.export_timeseries(q_gold_inverters(spark, sf))


def sites_bronze(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One site-list document per supplier (site), located by its nation and region; the
    snapshot day is ``SNAPSHOT_DAY``. Nation and region are the fixed-size dimensions."""
    s = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                 .join(region, nation.n_regionkey == region.r_regionkey))
    loc = F.struct(
        F.col("n_name").alias("address"),
        F.when(F.col("s_acctbal") < 0,
               F.concat(F.lit("Suite "), F.col("s_suppkey").cast("string"))).alias("address2"),
        F.col("r_name").alias("city"), F.col("n_name").alias("country"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("countryCode"),
        F.lit("UTC").alias("timeZone"),
        F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("zip"))
    site = F.struct(
        F.col("s_nationkey").cast("long").alias("accountId"),
        F.col("s_suppkey").alias("id"),
        F.concat((F.col("s_nationkey") + 2000).cast("string"), F.lit("-01-01"))
         .alias("installationDate"),
        F.col("s_name").alias("name"), F.lit("").alias("notes"),
        F.col("s_acctbal").alias("peakPower"),
        F.when(F.col("s_acctbal") >= 0, F.lit("Active")).otherwise(F.lit("Pending"))
         .alias("status"),
        F.lit("Optimizers & Inverters").alias("type"), loc.alias("location"))
    return s.select(F.struct(F.lit(1).cast("long").alias("count"),
                             F.array(site).alias("site")).alias("sites"),
                    F.lit(SNAPSHOT_DAY).alias("dt"))


def inventory_bronze(part: DataFrame) -> DataFrame:
    """One inventory document per part: site = brand, one inverter = the part."""
    inv = F.struct(F.col("p_brand").alias("manufacturer"), F.col("p_type").alias("model"),
                   F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("SN"))
    return part.select(F.struct(F.array(inv).alias("inverters")).alias("Inventory"),
                       F.lit(SNAPSHOT_DAY).alias("dt"), F.col("p_brand").alias("site_id"))


def q_silver_sites(spark, sf):
    return silver_ops.flatten_sites(sites_bronze(table(spark, sf, "supplier"),
                                                 table(spark, sf, "nation"),
                                                 table(spark, sf, "region")))


def q_gold_sites(spark, sf):
    return gold_ops.gold_sites(q_silver_sites(spark, sf))


def q_silver_inventory(spark, sf):
    return silver_ops.flatten_inventory(inventory_bronze(table(spark, sf, "part")))


def q_silver_checks(spark, sf):
    """The eight silver checks (Q1-Q8) on the three silver views, one report (Q9)."""
    return quality.report(quality.silver_checks(
        q_silver_inverters(spark, sf), q_silver_inventory(spark, sf),
        q_silver_sites(spark, sf), CHECKS_AS_OF))


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (``spark.checkpoint.dir``)."""
    import uuid

    from heliolake.session import checkpoint_dir
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def q_silver_from_landing(spark, sf):
    """K2 + S1 round trip: land the telemetry documents as JSON Lines partitioned by day,
    read them back with the explicit-schema bronze reader and flatten to silver."""
    from heliolake.sinks import land_bronze_json
    from heliolake.sources import read_inverter_bronze
    root = _scratch(spark, "landing")
    land_bronze_json(telemetry_bronze(table(spark, sf, "lineitem")), root, partition_cols=("dt",),
                     compression="gzip")
    return silver_ops.flatten_telemetry(read_inverter_bronze(spark, root))


def q_gold_day_range(spark, sf):
    """K1 + S5 round trip: write gold with the day overwrite, read ``[start, end)`` back."""
    from heliolake.sinks import write_day
    from heliolake.sources import read_table_range
    path = _scratch(spark, "gold")
    write_day(q_gold_inverters(spark, sf), path, distribute="rebalance")
    return read_table_range(spark, path, GOLD_RANGE_START, GOLD_RANGE_END) \
        .select(*GOLD_INVERTER_COLUMNS, "dt")


# ----------------------------------------------------------------------------------
# operator probes
# ----------------------------------------------------------------------------------
def q_events_range_clean(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", "value", EVENTS_RULE.expr().alias("value_clean"))


def q_lineitem_group_avg(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "l_net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_net"]
    agg = gold_ops.group_average(li, ["l_returnflag", "l_linestatus"], measures)
    return agg.select("l_returnflag", "l_linestatus",
                      *[F.round(m, ROUND_AVG).alias(m) for m in measures])


def q_phase_ops(spark, sf):
    li = table(spark, sf, "lineitem")
    p1 = F.when(F.col("l_discount") != 0, F.col("l_discount"))
    p2 = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    p3 = F.col("l_quantity")
    return li.select("l_orderkey", "l_linenumber",
                     phase_mean(p1, p2, p3).alias("phase_mean"),
                     phase_sum(p1, p2, p3).alias("phase_sum"),
                     power_factor(p1, p2, p3).alias("power_factor"))


def q_typed_literals(spark, sf):
    n = table(spark, sf, "nation")
    return n.select("n_nationkey", "n_name",
                    typed_null("double").alias("AC_Power"),
                    typed_null("double").alias("DC_Current"),
                    typed_null("double").alias("DC_Power"),
                    typed_null("string").alias("Account_id"),
                    F.lit(gold_ops.DATA_SOURCE).alias("Data_Source"),
                    F.lit(gold_ops.PLACEHOLDER_COORDINATE).alias("Latitude"),
                    F.lit(gold_ops.PLACEHOLDER_COORDINATE).alias("Longitude"))


def q_embedding_explode(spark, sf):
    e = table(spark, sf, "embeddings")
    return (e.select("vec_id", F.posexplode("embedding").alias("pos", "x"))
             .select("vec_id", "pos", F.col("x").cast("double").alias("x")))


def q_props_json(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int").getField("k").alias("k"))


def q_unpivot_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    filled = export_ops.fill_zero(li.select("l_orderkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_tax"))
    return export_ops.melt_measures(filled, ["l_orderkey", "l_linenumber"],
                                    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


def q_epoch_ms(spark, sf):
    ev = table(spark, sf, "events")
    s = F.date_format(F.col("ev_ts"), fd.DATETIME_FORMAT)
    return (ev.select("event_id", F.col("ts").cast("timestamp").alias("ev_ts"))
              .select("event_id", epoch_millis(s).alias("time_ms")))


def q_events_day_range(spark, sf):
    ev = table(spark, sf, "events")
    return (ev.filter(day_range_filter("ts", RANGE_START, RANGE_END))
              .select("event_id", "user_id", "event_type", "value",
                      F.date_format("ts", fd.DATE_FORMAT).alias("dt")))


def _events_dt(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.withColumn("dt", F.date_format("ts", fd.DATE_FORMAT))


def q_check_user_coverage(spark, sf):
    return quality.coverage_check(table(spark, sf, "events"), "user_id", EVENTS_AS_OF,
                                  "user_coverage", "fewer users yesterday than two days ago",
                                  DayOf("ts"))


def q_check_freshness(spark, sf):
    return quality.freshness_check(table(spark, sf, "events"), EVENTS_AS_OF, "events_fresh",
                                   "no events yesterday", DayOf("ts"))


def q_check_unique_orders(spark, sf):
    return quality.duplicate_check(table(spark, sf, "orders"), "orders_unique",
                                   "duplicate rows - orders")


def q_check_report(spark, sf):
    ev, day = table(spark, sf, "events"), DayOf("ts")
    return quality.report([
        quality.activity_checks(ev, {
            "user_id": ("user_coverage", "fewer users yesterday than two days ago"),
            "event_type": ("type_coverage", "fewer event types yesterday than two days ago")},
            ("events_fresh", "no events yesterday"), EVENTS_AS_OF, day),
        quality.duplicate_check(table(spark, sf, "orders"), "orders_unique",
                                "duplicate rows - orders"),
        quality.duplicate_check(table(spark, sf, "lineitem").select(
            "l_returnflag", "l_linestatus"), "flags_unique", "duplicate rows - flags"),
    ])


def _user_days(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events")
    return ev.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first_day"),
                                     F.max(F.to_date("ts")).alias("last_day"))


def q_user_day_range(spark, sf):
    u = _user_days(spark, sf)
    days = u.select("user_id", F.explode(fd.date_range("first_day", "last_day")).alias("day"))
    return _iso(days, "day")


def q_user_catch_up(spark, sf):
    u = _user_days(spark, sf)
    days = u.select("user_id",
                    F.explode(fd.catch_up_range(F.col("last_day"), CATCH_UP_AS_OF)).alias("day"))
    return _iso(days, "day")


def q_work_list(spark, sf):
    li = table(spark, sf, "lineitem")
    inventory = li.select(F.col("l_suppkey").alias("site_id"),
                          F.col("l_partkey").alias("inverter_id")).distinct()
    sites = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("site_id"))
    return _iso(incremental.work_list(sites, inventory, WORK_START, WORK_END), "day")


def q_missing_user_days(spark, sf):
    ev = table(spark, sf, "events")
    u = _user_days(spark, sf)
    expected = u.select("user_id", F.explode(
        F.sequence(F.col("first_day"), F.col("last_day"))).alias("day"))
    landed = ev.select("user_id", F.to_date("ts").alias("day"))
    return _iso(incremental.missing_work(expected, landed, keys=("user_id", "day")), "day")


def q_known_users(spark, sf):
    """Customers that are already in the event index (F4, ``site_id in index``)."""
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("site_id"), "c_name")
    idx = table(spark, sf, "events").select(F.col("user_id").alias("site_id"))
    return incremental.known_keys(c, idx).select(F.col("site_id").alias("c_custkey"), "c_name")


def _customer_sites(spark, sf) -> DataFrame:
    c, n, r = (table(spark, sf, "customer"), table(spark, sf, "nation"),
               table(spark, sf, "region"))
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select("c_custkey",
                     F.when(F.col("c_mktsegment") != "BUILDING",
                            F.col("c_mktsegment")).alias("address2"),
                     F.when(F.col("n_name") != "NATION_3", F.col("n_name")).alias("address"),
                     F.col("r_name").alias("city")))


def q_compose_address(spark, sf):
    s = _customer_sites(spark, sf)
    return s.select("c_custkey",
                    compose_address("address2", "address", "city").alias("query_address"))


def _supplier_lookup(spark, sf) -> DataFrame:
    s, n, r = (table(spark, sf, "supplier"), table(spark, sf, "nation"),
               table(spark, sf, "region"))
    addr = (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(compose_address(F.lit(None), F.col("n_name"), F.col("r_name"))
                     .alias("query_address"), "s_acctbal", "s_name"))
    return addr.groupBy("query_address").agg(F.min("s_name").alias("address"),
                                             F.min("s_acctbal").alias("latitude"),
                                             F.max("s_acctbal").alias("longitude"))


def _geocode(spark, sf):
    sites = q_compose_address(spark, sf)
    return geocode_join(sites, _supplier_lookup(spark, sf))


def q_geocode_match(spark, sf):
    matched, _ = _geocode(spark, sf)
    return matched.select("c_custkey", "query_address", "address", "latitude", "longitude")


def q_geocode_reject(spark, sf):
    _, rejected = _geocode(spark, sf)
    return rejected.select("c_custkey", "query_address")


def q_cursor_last_event(spark, sf):
    """Per customer: last event type and day from an events-built cursor, default date
    for customers without events (X4 over C1/C2)."""
    ev = table(spark, sf, "events")
    updates = ev.select(F.col("user_id").cast("string").alias("site_id"),
                        F.col("event_type").alias("serial_number"),
                        F.to_date("ts").alias("last_date"),
                        F.col("event_id").alias("seq"))
    pos = incremental.cursor_read(updates)
    sites = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("site_id"))
    looked = incremental.cursor_lookup(sites, updates)
    return (looked.join(pos.select("site_id", F.col("serial_number").alias("last_type")),
                        "site_id", "left")
                  .select(F.col("site_id").cast("bigint").alias("c_custkey"), "last_type",
                          F.date_format("start_date", fd.DATE_FORMAT).alias("start_date")))


def q_cursor_upsert(spark, sf):
    """Cursor from the first half of events, upserted with the second half."""
    ev = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("site_id"),
        F.col("event_type").alias("serial_number"),
        F.to_date("ts").alias("last_date"), F.col("event_id").alias("seq"),
        F.col("ts"))
    old = incremental.cursor_read(ev.filter(F.col("ts") < F.lit(RANGE_END).cast("timestamp"))
                                    .drop("ts"))
    upd = incremental.cursor_read(ev.filter(F.col("ts") >= F.lit(RANGE_END).cast("timestamp"))
                                    .drop("ts")).drop("seq")
    return incremental.cursor_upsert(old, upd).select(
        F.col("site_id").cast("bigint").alias("user_id"),
        F.col("serial_number").alias("last_type"),
        F.date_format("last_date", fd.DATE_FORMAT).alias("last_date"))


def q_day_ops(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey",
                                          F.col("o_orderdate").cast("timestamp").alias("od"))
    start, end = fd.day_bounds("od")
    s = F.date_format("od", fd.DATETIME_FORMAT)
    y, m, d = fd.date_parts(s)
    return o.select(
        "o_orderkey",
        F.date_format(start, fd.DATETIME_FORMAT).alias("day_start"),
        F.date_format(end, fd.DATETIME_FORMAT).alias("day_end"),
        F.date_format(fd.next_day(F.to_date("od")), fd.DATE_FORMAT).alias("next_day"),
        F.date_format(fd.parse_datetime(s), fd.DATETIME_FORMAT).alias("parsed"),
        y.alias("y"), m.alias("m"), d.alias("d"))


def q_run_days(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("t"))
    today = F.to_date("t")
    last_run = F.to_date(F.col("t") - F.expr("INTERVAL 30 MINUTES"))
    return ev.select("event_id",
                     F.date_format(fd.cutoff_day("t"), fd.DATE_FORMAT).alias("cutoff_day"),
                     F.date_format(fd.business_day(today, last_run), fd.DATE_FORMAT)
                     .alias("business_day"))


def q_overview_kpis(spark, sf):
    """Every order as an overview document: four energy KPIs at the order date."""
    o = table(spark, sf, "orders")
    e = lambda c: F.struct(c.alias("energy"))
    doc = o.select("o_orderkey", F.struct(
        F.date_format("o_orderdate", fd.DATETIME_FORMAT).alias("lastUpdateTime"),
        e(F.col("o_totalprice")).alias("lifeTimeData"),
        e(F.col("o_totalprice") / 10).alias("lastYearData"),
        e(F.col("o_totalprice") / 100).alias("lastMonthData"),
        e(F.col("o_totalprice") / 1000).alias("lastDayData")).alias("overview"))
    return kpi.overview_kpis(doc)


def q_power_series(spark, sf):
    """Every embedding as a power series document, 5-minute points."""
    emb = table(spark, sf, "embeddings")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp")
    values = F.transform("embedding", lambda x, i: F.struct(
        F.date_format(base + F.make_interval(mins=i * 5), fd.DATETIME_FORMAT).alias("date"),
        x.cast("double").alias("value")))
    doc = emb.select("vec_id", F.struct(values.alias("values")).alias("power"))
    return kpi.power_series(doc)


def q_energy_series(spark, sf):
    """Every embedding as an energy series document, 15-minute points."""
    emb = table(spark, sf, "embeddings")
    base = F.lit("2024-01-01 00:00:00").cast("timestamp")
    values = F.transform("embedding", lambda x, i: F.struct(
        F.date_format(base + F.make_interval(mins=i * 15), fd.DATETIME_FORMAT).alias("date"),
        (x.cast("double") * 1000).alias("value")))
    doc = emb.select("vec_id", F.struct(values.alias("values")).alias("energy"))
    return kpi.energy_series(doc)


def q_data_period(spark, sf):
    """Orders as data-period documents; pending orders have a blank start."""
    o = table(spark, sf, "orders")
    start = F.when(F.col("o_orderstatus") != "P",
                   F.date_format("o_orderdate", fd.DATE_FORMAT)).otherwise(F.lit(""))
    end = F.date_format(F.date_add(F.to_date("o_orderdate"), 30), fd.DATE_FORMAT)
    doc = o.select("o_orderkey", F.struct(start.alias("startDate"),
                                          end.alias("endDate")).alias("dataPeriod"))
    return _iso(kpi.data_period(doc), "start_date", "end_date")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_inverters": q_silver_inverters,
    "silver_error_bodies": q_silver_error_bodies,
    "gold_inverters": q_gold_inverters,
    "gold_agg": q_gold_agg,
    "export_long": q_export_long,
    "silver_sites": q_silver_sites,
    "gold_sites": q_gold_sites,
    "silver_inventory": q_silver_inventory,
    "silver_checks": q_silver_checks,
    "silver_from_landing": q_silver_from_landing,
    "gold_day_range": q_gold_day_range,
    "events_range_clean": q_events_range_clean,
    "lineitem_group_avg": q_lineitem_group_avg,
    "phase_ops": q_phase_ops,
    "typed_literals": q_typed_literals,
    "embedding_explode": q_embedding_explode,
    "props_json": q_props_json,
    "unpivot_lineitem": q_unpivot_lineitem,
    "epoch_ms": q_epoch_ms,
    "events_day_range": q_events_day_range,
    "check_user_coverage": q_check_user_coverage,
    "check_freshness": q_check_freshness,
    "check_unique_orders": q_check_unique_orders,
    "check_report": q_check_report,
    "user_day_range": q_user_day_range,
    "user_catch_up": q_user_catch_up,
    "work_list": q_work_list,
    "missing_user_days": q_missing_user_days,
    "known_users": q_known_users,
    "compose_address": q_compose_address,
    "geocode_match": q_geocode_match,
    "geocode_reject": q_geocode_reject,
    "cursor_last_event": q_cursor_last_event,
    "cursor_upsert": q_cursor_upsert,
    "day_ops": q_day_ops,
    "run_days": q_run_days,
    "overview_kpis": q_overview_kpis,
    "power_series": q_power_series,
    "energy_series": q_energy_series,
    "data_period": q_data_period,
}
