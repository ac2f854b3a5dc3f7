"""DuckDB SQL twins of ``heliolake.plans.storage.STORAGE_QUERIES`` (same column names)."""

from __future__ import annotations

from heliolake.plans import driver as d
from heliolake.plans.oracle import (_LOOKUP, _SITES, TS_FMT, _silver_inventory_sql,
                                    _silver_sites_sql, cleaned_sql)

_DAY = "CASE WHEN s_suppkey % 2 = 0 THEN '2024-03-01' ELSE '2024-03-02' END"
_TELEMETRY = f"""t AS (
    SELECT CAST(s_nationkey AS VARCHAR) AS site, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS inv,
           {_DAY} || ' 10:00:00' AS read_at, s_acctbal AS energy, s_acctbal / 100 AS cur,
           CAST(s_nationkey * 10 AS DOUBLE) AS volt, {_DAY} AS dt FROM supplier)"""


def _kpis(key: str, source: str, time: str, value: str, rest: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, CAST({i} AS BIGINT) AS \"Id\", {time} AS \"UpdateTimeUtc\", "
        f"{value} / {n} AS \"Value\"{rest} FROM {source}"
        for i, n in ((1, 1), (2, 2), (3, 4), (4, 8)))


def _more_kpis(key: str, source: str, time: str, value: str, rest: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, CAST({i} AS BIGINT) AS \"Id\", {time} AS \"UpdateTimeUtc\", "
        f"{value} / {n} AS \"Value\"{rest} FROM {source}" for i, n in ((6, 16), (5, 32)))


_GOOD = (f"strftime(o_orderdate, {TS_FMT})")
_LATER = f"ts >= TIMESTAMP '{d.EVENTS_AS_OF}'"
_KPI_ORDER = ("substr(o_orderpriority, 1, 1) AS site_id", "orders", _GOOD, "o_totalprice",
              ", CAST(year(o_orderdate) AS VARCHAR) || '-01-01' AS dt")

STORAGE_ORACLE: dict[str, str] = {
    "telemetry_path_ids": (
        f"WITH {_TELEMETRY} SELECT site AS \"Local_site_id\", inv AS \"Local_inverter_id\", "
        "read_at AS \"Datetime\", energy AS \"AC_Energy\", cur AS \"AC_Current_L1\", dt FROM t"),
    "inventory_from_landing": _silver_inventory_sql(),
    "sites_from_landing": _silver_sites_sql(),
    "events_one_day": (
        "SELECT event_id, user_id, value, strftime(ts, '%Y-%m-%d') AS dt FROM events "
        f"WHERE strftime(ts, '%Y-%m-%d') = '{d.EVENTS_AS_OF}'"),
    "pretty_overviews": _kpis("s_suppkey", "supplier", "'2024-03-01 08:00:00'", "s_acctbal"),
    "kpi_from_landing": _kpis(*_KPI_ORDER) + " UNION ALL " + _more_kpis(*_KPI_ORDER),
    "bronze_rejects": (
        "SELECT CAST(c_nationkey AS VARCHAR) AS site_id, "
        "CASE WHEN c_custkey % 4 = 1 THEN 'not JSON' ELSE 'no data.telemetries' END AS reason, "
        "count(*) AS n, CAST(min(CASE WHEN c_custkey % 4 = 1 THEN 25 ELSE 13 END) AS INTEGER) "
        "AS shortest FROM customer WHERE c_custkey % 4 IN (1, 2) GROUP BY ALL"),
    "day_rerun_empty": " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", dt, CAST({n} AS BIGINT) AS n FROM (SELECT {_DAY} AS dt "
        f"FROM supplier WHERE s_suppkey % 2 = 1) GROUP BY dt"
        for name, n in (("silver", "count(*)"), ("gold", "count(*)"), ("agg", "1"),
                        ("export", "18 * count(*)"))),
    "stream_refresh": (
        f"WITH {_TELEMETRY} SELECT site AS \"Local_site_id\", inv AS \"Local_inverter_id\", "
        f"read_at AS \"Datetime\", energy AS \"AC_Energy\", {cleaned_sql('cur', (200, 210))} AS "
        f"\"AC_Current_L1\", {cleaned_sql('volt', (200, 210))} AS \"AC_Voltage_L1\", dt FROM t"),
    "catalog_partitions": (
        "SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, max(event_id) AS last_event "
        "FROM events GROUP BY strftime(ts, '%Y-%m-%d')"),
    "vendor_inverters": " UNION ALL ".join(
        f"SELECT CAST(s_nationkey AS VARCHAR) AS site_key, '{x}' || CAST(s_suppkey AS VARCHAR) "
        "AS inverter_id FROM supplier JOIN nation ON s_nationkey = n_nationkey" for x in "AB"),
    "raw_landing": (
        "SELECT s_suppkey, '2024-03-01' AS dt, s_suppkey % 7 <> 0 AS is_json, "
        "CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS v FROM supplier"),
    "merged_pages": (
        "SELECT *, announced = received AS complete FROM (SELECT "
        "strftime(DATE '2024-03-01' + CAST(c_nationkey AS INTEGER), '%Y-%m-%d') AS dt, "
        "CAST(max(c_nationkey + 60) AS BIGINT) AS announced, "
        "CAST(sum(CASE WHEN c_acctbal >= 0 THEN 1 ELSE 2 END) AS BIGINT) AS received "
        "FROM customer GROUP BY c_nationkey)"),
    "sites_csv": (
        f"WITH {_SITES}, {_LOOKUP} SELECT 'site \"' || CAST(c_custkey AS VARCHAR) || '\", x' AS "
        "name, CAST(c_custkey AS DOUBLE) AS peak_power, address, latitude, longitude FROM sites "
        "JOIN lk ON sites.query_address = lk.query_address"),
    "snapshot_retention": ("SELECT c_custkey, upper(c_name || ' b') AS c_name, '2024-03-02' AS dt "
                           "FROM customer"),
    "full_refresh": "SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer",
    "components": ("SELECT p_size, CAST(p_partkey AS VARCHAR) AS serial_number, p_name AS name, "
                   "p_brand AS manufacturer, p_type AS model FROM part"),
    "catch_up_from_landing": (
        "SELECT CAST(s_nationkey AS VARCHAR) AS site_id, "
        "lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS inverter_id, "
        "CASE WHEN s_suppkey % 2 = 0 THEN '2024-03-02' ELSE '2024-03-01' END AS day "
        "FROM supplier"),
    "stored_cursor": (
        "SELECT user_id, coalesce(CASE WHEN user_id % 2 = 0 THEN arg_max(event_type, event_id) "
        f"FILTER (WHERE {_LATER}) END, arg_max(event_type, event_id) FILTER (WHERE NOT {_LATER})) "
        f"AS last_type, strftime(coalesce(arg_max(CAST(ts AS DATE), event_id) FILTER (WHERE "
        f"{_LATER}), arg_max(CAST(ts AS DATE), event_id) FILTER (WHERE NOT {_LATER})), "
        "'%Y-%m-%d') AS last_date FROM events GROUP BY user_id"),
    "hourly_runs": (
        f"WITH {_TELEMETRY} SELECT dt, 'Solar Edge' AS \"Data_Source\", count(*) AS n, "
        "round(sum(energy), 2) AS energy FROM t GROUP BY dt"),
    "tolerant_parsing": (
        f"SELECT o_orderkey, CASE WHEN r = 0 THEN g END AS parsed, CASE WHEN r = 0 THEN "
        "CAST(CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS VARCHAR) END AS time_ms, "
        "CASE WHEN r IN (0, 2) THEN CAST(year(o_orderdate) AS VARCHAR) END AS y, "
        "CASE WHEN r IN (0, 2) THEN CAST(month(o_orderdate) AS VARCHAR) END AS m, "
        "CASE WHEN r = 0 THEN CAST(day(o_orderdate) AS VARCHAR) END AS d, "
        "CASE WHEN r = 0 THEN substr(g, 1, 10) END AS start_date, CAST(NULL AS VARCHAR) AS "
        f"end_date FROM (SELECT *, o_orderkey % 5 AS r, {_GOOD} AS g FROM orders)"),
}
