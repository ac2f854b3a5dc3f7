"""DuckDB SQL twins of ``heliolake.plans.changes.CHANGE_QUERIES`` (same column names)."""

from __future__ import annotations

from heliolake.plans import changes as c
from heliolake.plans.oracle import (_SITES, _addr, _gold_sql, _half_up, _silver_sql,
                                    cleaned_sql)
from heliolake.plans.oracle_storage import _TELEMETRY, STORAGE_ORACLE
from heliolake.plans.driver import GOLD_RANGE_END, GOLD_RANGE_START, ROUND_AVG
from heliolake.schemas import AGG_MEASURES, EXPORT_MEASURES

#: Measures that ``supplier_telemetry`` gives; all others are NULL and exported as 0.
_GIVEN = {"AC_Energy": "energy", "AC_Current_L1": cleaned_sql("cur", (200, 210)),
          "AC_Voltage_L1": cleaned_sql("volt", (200, 210))}


def _records_sql() -> str:
    return f"WITH {_TELEMETRY} " + " UNION ALL ".join(
        f"SELECT 'run-1' AS run, 'Solar Edge' AS data_source, site AS local_site_id, "
        f"inv AS local_inverter_id, '{m.lower()}' AS measure_name, "
        f"{_half_up(f'coalesce({_GIVEN[m]}, 0)') if m in _GIVEN else 'CAST(0 AS DOUBLE)'} AS "
        "measure_value, CAST(epoch(strptime(read_at, '%Y-%m-%d %H:%M:%S')) AS BIGINT) * 1000 AS time "
        "FROM t" for m in EXPORT_MEASURES)


def _drift_sql() -> str:
    fields = (("$[''name'']", "string", "ok", "0"), ("$[''key'']", "bigint", "ok", "0"),
              ("$[''m''][''v'']", "double", "ok AND c_custkey % 4 <> 0", "ok AND c_custkey % 4 = 1"))
    base = ("b AS (SELECT *, c_custkey % 9 <> 0 AS ok, c_mktsegment AS vendor, "
            "strftime(DATE '2024-03-01' + CAST(c_nationkey % 5 AS INTEGER), '%Y-%m-%d') AS dt "
            "FROM customer)")
    return f"WITH {base} " + " UNION ALL ".join(
        f"SELECT vendor, dt, count(*) FILTER (ok) AS documents, '{field}' AS field, "
        f"'{kind}' AS declared, count(*) FILTER ({present}) AS present, "
        f"{'CAST(0 AS BIGINT)' if unfit == '0' else f'count(*) FILTER ({unfit})'} AS unfit, "
        "count(*) AS n, count(*) FILTER (NOT ok) AS n_not_json FROM b GROUP BY vendor, dt"
        for field, kind, present, unfit in fields)


_DAY_OF_3 = ("CASE s_suppkey % 3 WHEN 0 THEN '2024-03-01' WHEN 1 THEN '2024-03-02' "
             "ELSE '2024-03-03' END")

CHANGE_ORACLE: dict[str, str] = {
    "versioned_range": (
        f"WITH g AS ({_gold_sql()}) SELECT Local_site_id, Local_inverter_id, Datetime, AC_Energy, "
        f"CASE WHEN dt >= '{GOLD_RANGE_START}' AND dt < '{GOLD_RANGE_END}' THEN 'Second' "
        "ELSE Data_Source END AS Data_Source, dt FROM g"),
    "versioned_counts": (
        "SELECT dt, CAST(CASE WHEN dt IN ('2024-01-10', '2024-01-11') THEN 0 ELSE n END AS BIGINT) "
        "AS rows FROM (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n FROM events GROUP BY 1)"),
    "versioned_rerun": STORAGE_ORACLE["day_rerun_empty"],
    "late_day_runs": (
        f"SELECT {_DAY_OF_3} AS dt, count(*) AS n, round(sum(s_acctbal), 2) AS energy, "
        f"CAST(CASE WHEN s_suppkey % 3 = 1 THEN 2 ELSE 1 END AS INTEGER) AS run, "
        "CASE WHEN s_suppkey % 3 = 1 THEN '2024-03-03' ELSE '2024-03-01' END AS marker, "
        "CASE WHEN s_suppkey % 3 = 1 THEN '2024-03-04 01:10:00' ELSE '2024-03-04 00:10:00' END "
        "AS moment FROM supplier GROUP BY s_suppkey % 3"),
    "site_catch_up": (
        "WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, CASE WHEN user_id % 2 = 0 "
        f"THEN DATE '{c.KNOWN_AT}' ELSE DATE '2023-12-31' END AS start FROM events "
        f"WHERE CAST(ts AS DATE) <= DATE '{c.LOOK_UNTIL}'), "
        "k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS rn FROM d "
        "WHERE day > start) SELECT user_id, strftime(max(day) FILTER (day = start + CAST(rn AS "
        "INTEGER)), '%Y-%m-%d') AS last_date, CAST(date_diff('day', any_value(start), "
        f"DATE '{c.LOOK_UNTIL}') - count(*) AS INTEGER) AS open_days FROM k GROUP BY user_id "
        "HAVING count(*) FILTER (day = start + CAST(rn AS INTEGER)) > 0"),
    "geocode_ambiguous": (
        f"WITH {_SITES}, lk AS (SELECT query_address, min(address) AS address, "
        "min(latitude) AS latitude, count(DISTINCT latitude) > 1 AS many FROM (SELECT "
        + _addr("NULL", "n_name", "r_name") + " AS query_address, r_name AS address, "
        "CASE WHEN n_nationkey % 3 = 0 THEN s_acctbal ELSE CAST(n_nationkey AS DOUBLE) END AS latitude "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = "
        "r_regionkey) GROUP BY query_address) SELECT c_custkey, sites.query_address, "
        "CASE WHEN NOT many THEN address END AS address, CASE WHEN NOT many THEN latitude END AS "
        "latitude, coalesce(NOT many, false) AS hit, CASE WHEN many IS NULL THEN 'no hit' WHEN many "
        "THEN 'ambiguous' END AS reason FROM sites LEFT JOIN lk ON sites.query_address = "
        "lk.query_address"),
    "agg_from_states": (
        "SELECT Account_id, Data_Source, DC_Current, dt, " + ", ".join(
            f"{_half_up(f'avg({m}) + {c.OFF_BORDER:.8f}', ROUND_AVG)} AS {m}" for m in AGG_MEASURES)
        + f" FROM ({_gold_sql()}) GROUP BY Account_id, Data_Source, DC_Current, dt"),
    "changed_slots_stream": (
        f"WITH {_TELEMETRY}, u AS (SELECT site, inv, CASE WHEN site = '3' AND dt = '2024-03-01' "
        "THEN energy * 2 ELSE energy END AS e, dt FROM t), a AS (SELECT dt, "
        f"{_half_up(f'avg(e) + {c.OFF_BORDER:.8f}', ROUND_AVG)} AS "
        "day_mean FROM u GROUP BY dt) SELECT site AS \"Local_site_id\", inv AS "
        "\"Local_inverter_id\", e AS \"AC_Energy\", u.dt, day_mean FROM u JOIN a ON u.dt = a.dt"),
    "export_records": _records_sql(),
    "compacted_landing": (
        f"WITH {_TELEMETRY} SELECT site AS \"Local_site_id\", inv AS \"Local_inverter_id\", "
        "read_at AS \"Datetime\", CASE WHEN day = '2024-03-02' THEN energy + 1 ELSE energy END AS "
        f"\"AC_Energy\", day AS dt FROM (SELECT *, {_DAY_OF_3.replace('s_suppkey', 'CAST(inv AS BIGINT)')} "
        "AS day FROM t) WHERE day >= '2024-03-02'"),
    "check_copied_events": (
        "SELECT 'events_unique' AS \"check\", n = d AS passed, n AS observed, d AS expected, "
        "'identical events' AS message FROM (SELECT count(*) + count(*) FILTER (event_id % 5 = 0) "
        "AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM events)) AS d FROM events)"),
    "check_silver_copies": (
        f"WITH s AS ({_silver_sql()}) SELECT (SELECT CAST(sum(1 + CAST(Local_inverter_id AS BIGINT) "
        "% 3) AS BIGINT) FROM s) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM s)) AS n_distinct"),
    "landing_drift": _drift_sql(),
}
