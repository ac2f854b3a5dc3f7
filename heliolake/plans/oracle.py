"""DuckDB SQL twins of ``heliolake.plans.driver.QUERIES`` (same column names)."""

from __future__ import annotations

from heliolake.plans import driver as d
from heliolake.schemas import AGG_MEASURES, EXPORT_MEASURES, GOLD_INVERTER_COLUMNS

TS_FMT = "'%Y-%m-%d %H:%M:%S'"


def _silver_sql() -> str:
    l3 = "CASE WHEN l_linenumber > 1 THEN {} END"
    return f"""
    WITH b AS (
      SELECT CAST(l_suppkey AS VARCHAR) AS Local_site_id,
             CAST(l_partkey AS VARCHAR) AS Local_inverter_id,
             strftime(l_shipdate + to_minutes(l_linenumber * 15), {TS_FMT}) AS Datetime,
             l_extendedprice / l_quantity AS DC_Voltage,
             l_tax * 500 AS Temperature,
             l_quantity * 100 AS Active_Power,
             l_extendedprice AS AC_Energy,
             l_quantity * 5 - 20 AS AC_Current_L1,
             l_quantity + 180 AS AC_Voltage_L1,
             CASE WHEN l_discount <> 0 THEN 1 - l_discount END AS L1Data_cosPhi,
             l_tax * 100 - 2 AS L1Data_reactivePower,
             l_quantity * 4.5 - 5 AS AC_Current_L2,
             l_quantity + 200 AS AC_Voltage_L2,
             1 - l_tax AS L2Data_cosPhi,
             l_discount * 100 - 1.5 AS L2Data_reactivePower,
             {l3.format("l_quantity * 5.5 - 30")} AS AC_Current_L3,
             {l3.format("l_quantity + 205")} AS AC_Voltage_L3,
             {l3.format("CAST(0.9 AS DOUBLE)")} AS L3Data_cosPhi,
             {l3.format("l_tax * 10")} AS L3Data_reactivePower,
             strftime(l_shipdate, '%Y-%m-%d') AS dt
      FROM lineitem
    )
    SELECT Local_site_id, Local_inverter_id, Datetime, DC_Voltage, Temperature, Active_Power,
           AC_Energy, AC_Current_L1, AC_Voltage_L1, L1Data_cosPhi, L1Data_reactivePower,
           AC_Current_L2, AC_Voltage_L2, L2Data_cosPhi, L2Data_reactivePower,
           AC_Current_L3, AC_Voltage_L3, L3Data_cosPhi, L3Data_reactivePower,
           (AC_Current_L1 + AC_Current_L2 + AC_Current_L3) / 3 AS AC_Current,
           (AC_Voltage_L1 + AC_Voltage_L2 + AC_Voltage_L3) / 3 AS AC_Voltage,
           L1Data_reactivePower + L2Data_reactivePower + L3Data_reactivePower AS Reactive_Power,
           coalesce(L1Data_cosPhi, L2Data_cosPhi, L3Data_cosPhi) AS Power_Factor,
           CAST(NULL AS DOUBLE) AS AC_Power, CAST(NULL AS DOUBLE) AS DC_Current,
           CAST(NULL AS DOUBLE) AS DC_Power, CAST(NULL AS VARCHAR) AS Account_id, dt
    FROM b"""


# Cap and limit of the cleaned gold columns, written out apart from the library's
# rule table so that a wrong limit there shows.
GOLD_LIMITS = {
    "AC_Current_L1": (200, 210), "AC_Current_L2": (200, 210), "AC_Current_L3": (200, 210),
    "AC_Voltage_L1": (200, 210), "AC_Voltage_L2": (240, 250), "AC_Voltage_L3": (240, 250),
    "AC_Current": (240, 260), "Reactive_Power": None,
}


def cleaned_sql(c: str, limits: tuple[int, int] | None) -> str:
    high = "" if limits is None else (f"WHEN {c} > {limits[1]} THEN NULL "
                                      f"WHEN {c} >= {limits[0]} THEN {limits[0]} ")
    return f"CASE WHEN {c} < -1 THEN NULL WHEN {c} <= 0 THEN 0 {high}ELSE {c} END"


def _gold_sql() -> str:
    cols = []
    for c in GOLD_INVERTER_COLUMNS:
        if c == "Data_Source":
            cols.append(f"'{d.gold_ops.DATA_SOURCE}' AS Data_Source")
        elif c in GOLD_LIMITS:
            cols.append(f"{cleaned_sql(c, GOLD_LIMITS[c])} AS {c}")
        else:
            cols.append(c)
    return f"WITH s AS ({_silver_sql()}) SELECT {', '.join(cols)}, dt FROM s"


def _agg_sql() -> str:
    avgs = ", ".join(f"{_half_up(f'avg({m})', d.ROUND_AVG)} AS {m}" for m in AGG_MEASURES)
    return (f"WITH g AS ({_gold_sql()}) SELECT Account_id, Data_Source, DC_Current, dt, {avgs} "
            "FROM g GROUP BY Account_id, Data_Source, DC_Current, dt")


def _fill(c: str) -> str:
    if c == "Account_id":
        return "CAST(coalesce(Account_id, '0') AS DOUBLE)"
    return f"CASE WHEN isnan({c}) THEN 0.0 ELSE coalesce({c}, 0.0) END"


def _half_up(x: str, scale: int = 3) -> str:
    """HALF_UP on the shortest decimal form of the double, as Spark's ``round`` does
    (DuckDB's own ``round`` multiplies first and can cross a .5 boundary)."""
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38, 20)), {scale}) AS DOUBLE)"


def _export_sql() -> str:
    parts = []
    for m in EXPORT_MEASURES:
        parts.append(
            f"SELECT data_source_ AS data_source, local_site_id_ AS local_site_id, "
            f"local_inverter_id_ AS local_inverter_id, time, dt, "
            f"'{m.lower()}' AS measure_name, {_half_up(_fill(m))} AS measure_value "
            f"FROM base")
    meas = ", ".join(EXPORT_MEASURES)
    return (f"WITH g AS ({_gold_sql()}), base AS (SELECT Data_Source AS data_source_, "
            f"Local_site_id AS local_site_id_, Local_inverter_id AS local_inverter_id_, "
            f"CAST(epoch(strptime(Datetime, {TS_FMT})) AS BIGINT) * 1000 AS time, dt, {meas} "
            f"FROM g) "
            + " UNION ALL ".join(parts))


def _events_rule_sql() -> str:
    return f"SELECT event_id, value, {d.EVENTS_RULE.sql('value')} AS value_clean FROM events"


_P1 = "CASE WHEN l_discount <> 0 THEN l_discount END"
_P2 = "CASE WHEN l_tax <> 0 THEN l_tax END"
_P3 = "l_quantity"


def _unpivot_sql() -> str:
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{c}' AS measure_name, "
        f"{_half_up(_fill(c))} AS measure_value FROM lineitem" for c in cols)


def _day(n: int) -> str:
    import datetime as _dt
    return (_dt.date.fromisoformat(d.EVENTS_AS_OF) - _dt.timedelta(days=n)).isoformat()


def _coverage_sql(col: str, name: str, msg: str) -> str:
    return (f"SELECT '{name}' AS \"check\", a >= b AS passed, a AS observed, b AS expected, "
            f"'{msg}' AS message FROM "
            f"(SELECT count(DISTINCT {col}) AS a FROM events WHERE strftime(ts, '%Y-%m-%d') = '{_day(1)}') x, "
            f"(SELECT count(DISTINCT {col}) AS b FROM events WHERE strftime(ts, '%Y-%m-%d') = '{_day(2)}') y")


def _fresh_sql() -> str:
    return (f"SELECT 'events_fresh' AS \"check\", n > 0 AS passed, n AS observed, "
            f"CAST(1 AS BIGINT) AS expected, 'no events yesterday' AS message FROM "
            f"(SELECT count(*) AS n FROM events WHERE strftime(ts, '%Y-%m-%d') = '{_day(1)}')")


def _unique_sql(source: str, name: str, msg: str) -> str:
    return (f"SELECT '{name}' AS \"check\", n = c AS passed, n AS observed, c AS expected, "
            f"'{msg}' AS message FROM (SELECT count(*) AS n FROM {source}) x, "
            f"(SELECT count(*) AS c FROM (SELECT DISTINCT * FROM {source})) y")


_USER_DAYS = ("u AS (SELECT user_id, min(CAST(ts AS DATE)) AS f, max(CAST(ts AS DATE)) AS l "
              "FROM events GROUP BY user_id)")


def _addr(a2: str, a: str, city: str) -> str:
    a2, a, city = (f"coalesce({a2}, '')", f"coalesce({a}, '')", f"coalesce({city}, '')")
    return (f"CASE WHEN {a2} <> '' THEN {a2} || ' ' || {a} || ' ' || {city} "
            f"WHEN {a} <> '' THEN {a} || ' ' || {city} ELSE {city} END")


_SITES = ("sites AS (SELECT c_custkey, "
          + _addr("CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END",
                  "CASE WHEN n_name <> 'NATION_3' THEN n_name END", "r_name")
          + " AS query_address FROM customer JOIN nation ON c_nationkey = n_nationkey "
            "JOIN region ON n_regionkey = r_regionkey)")
_LOOKUP = ("lk AS (SELECT query_address, min(s_name) AS address, min(s_acctbal) AS latitude, "
           "max(s_acctbal) AS longitude FROM (SELECT " + _addr("NULL", "n_name", "r_name")
           + " AS query_address, s_name, s_acctbal FROM supplier JOIN nation ON "
             "s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) "
             "GROUP BY query_address)")

_LAST = ("SELECT user_id, arg_max(event_type, event_id) AS t, "
         "arg_max(CAST(ts AS DATE), event_id) AS d FROM events {where} GROUP BY user_id")


def _silver_sites_sql() -> str:
    return (
        "SELECT CAST(s_nationkey AS BIGINT) AS Account_id, s_suppkey AS Id, "
        "CAST(s_nationkey + 2000 AS VARCHAR) || '-01-01' AS Installation_Date, "
        "s_name AS Name, '' AS Comment, s_acctbal AS Peak_Power, "
        "CASE WHEN s_acctbal >= 0 THEN 'Active' ELSE 'Pending' END AS Status, "
        "'Optimizers & Inverters' AS Type, n_name AS location_address, "
        "CASE WHEN s_acctbal < 0 THEN 'Suite ' || CAST(s_suppkey AS VARCHAR) END "
        "AS location_address2, r_name AS location_city, n_name AS location_country, "
        "'N' || CAST(s_nationkey AS VARCHAR) AS location_countryCode, "
        "'UTC' AS location_timeZone, lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS location_zip, "
        f"'{d.SNAPSHOT_DAY}' AS dt "
        "FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        "JOIN region ON n_regionkey = r_regionkey")


def _silver_inventory_sql() -> str:
    return ("SELECT p_brand AS Local_Parent_Id, p_brand AS Manufacturer, p_type AS Model, "
            f"p_name AS Name, CAST(p_partkey AS VARCHAR) AS Id, '{d.SNAPSHOT_DAY}' AS dt FROM part")


def _silver_checks_sql() -> str:
    import datetime as _dt

    from heliolake.operators.quality import MESSAGES as M
    as_of = _dt.date.fromisoformat(d.CHECKS_AS_OF)
    d1 = (as_of - _dt.timedelta(days=1)).isoformat()
    d2 = (as_of - _dt.timedelta(days=2)).isoformat()

    def cov(col, name):
        return (f"SELECT '{name}' AS \"check\", a >= b AS passed, a AS observed, b AS expected, "
                f"'{M[name]}' AS message FROM "
                f"(SELECT count(DISTINCT {col}) AS a FROM inv WHERE dt = '{d1}') x, "
                f"(SELECT count(DISTINCT {col}) AS b FROM inv WHERE dt = '{d2}') y")

    def fresh(t, name):
        return (f"SELECT '{name}' AS \"check\", n > 0 AS passed, n AS observed, "
                f"CAST(1 AS BIGINT) AS expected, '{M[name]}' AS message FROM "
                f"(SELECT count(*) AS n FROM {t} WHERE dt = '{d1}')")

    def uniq(t, name):
        return (f"SELECT '{name}' AS \"check\", n = c AS passed, n AS observed, c AS expected, "
                f"'{M[name]}' AS message FROM (SELECT count(*) AS n FROM {t}) x, "
                f"(SELECT count(*) AS c FROM (SELECT DISTINCT * FROM {t})) y")

    parts = [cov("Local_inverter_id", "inverter_coverage"), cov("Local_site_id", "site_coverage"),
             fresh("inv", "inverters_fresh"), fresh("nvt", "inventory_fresh"),
             fresh("sites", "sites_fresh"), uniq("inv", "inverters_unique"),
             uniq("nvt", "inventory_unique"), uniq("sites", "sites_unique")]
    return (f"WITH inv AS ({_silver_sql()}), nvt AS ({_silver_inventory_sql()}), "
            f"sites AS ({_silver_sites_sql()}) " + " UNION ALL ".join(parts))


ORACLE_SQL: dict[str, str] = {
    "silver_inverters": _silver_sql(),
    "silver_error_bodies": _silver_sql(),
    "gold_inverters": _gold_sql(),
    "gold_agg": _agg_sql(),
    "export_long": _export_sql(),
    "silver_sites": _silver_sites_sql(),
    "gold_sites": (f"WITH s AS ({_silver_sites_sql()}) SELECT Id, Name, Status, Peak_Power, "
                   "Installation_Date, Comment, Type, Account_id, 0 AS Latitude, "
                   "0 AS Longitude, dt FROM s"),
    "silver_inventory": _silver_inventory_sql(),
    "silver_checks": _silver_checks_sql(),
    "silver_from_landing": _silver_sql(),
    "gold_day_range": (f"WITH g AS ({_gold_sql()}) SELECT * FROM g WHERE dt >= "
                       f"'{d.GOLD_RANGE_START}' AND dt < '{d.GOLD_RANGE_END}'"),
    "events_range_clean": _events_rule_sql(),
    "lineitem_group_avg": (
        "SELECT l_returnflag, l_linestatus, "
        + ", ".join(f"round(avg({m}), {d.ROUND_AVG}) AS {m}" for m in
                    ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
        + f", round(avg(l_extendedprice * (1 - l_discount)), {d.ROUND_AVG}) AS l_net "
          "FROM lineitem GROUP BY l_returnflag, l_linestatus"),
    "phase_ops": (
        f"SELECT l_orderkey, l_linenumber, ({_P1} + {_P2} + {_P3}) / 3 AS phase_mean, "
        f"{_P1} + {_P2} + {_P3} AS phase_sum, coalesce({_P1}, {_P2}, {_P3}) AS power_factor "
        "FROM lineitem"),
    "typed_literals": (
        "SELECT n_nationkey, n_name, CAST(NULL AS DOUBLE) AS AC_Power, "
        "CAST(NULL AS DOUBLE) AS DC_Current, CAST(NULL AS DOUBLE) AS DC_Power, "
        "CAST(NULL AS VARCHAR) AS Account_id, 'Solar Edge' AS Data_Source, "
        "0 AS Latitude, 0 AS Longitude FROM nation"),
    "embedding_explode": (
        "SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, CAST(x AS DOUBLE) AS x FROM "
        "(SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i "
        "FROM embeddings)"),
    "props_json": "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k FROM events",
    "unpivot_lineitem": _unpivot_sql(),
    "epoch_ms": ("SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) * 1000 "
                 "AS time_ms FROM events"),
    "events_day_range": (
        "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS dt FROM events "
        f"WHERE ts >= TIMESTAMP '{d.RANGE_START}' AND ts < TIMESTAMP '{d.RANGE_END}'"),
    "check_user_coverage": _coverage_sql("user_id", "user_coverage",
                                         "fewer users yesterday than two days ago"),
    "check_freshness": _fresh_sql(),
    "check_unique_orders": _unique_sql("orders", "orders_unique", "duplicate rows - orders"),
    "check_report": " UNION ALL ".join([
        _coverage_sql("user_id", "user_coverage", "fewer users yesterday than two days ago"),
        _coverage_sql("event_type", "type_coverage",
                      "fewer event types yesterday than two days ago"),
        _fresh_sql(),
        _unique_sql("orders", "orders_unique", "duplicate rows - orders"),
        _unique_sql("(SELECT l_returnflag, l_linestatus FROM lineitem)", "flags_unique",
                    "duplicate rows - flags"),
    ]),
    "user_day_range": (
        f"WITH {_USER_DAYS} SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT user_id, "
        "CAST(unnest(range(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) "
        "AS day FROM u)"),
    "user_catch_up": (
        f"WITH {_USER_DAYS} SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT user_id, "
        "CAST(unnest(generate_series(CAST(l AS TIMESTAMP), "
        f"TIMESTAMP '{d.CATCH_UP_AS_OF}', INTERVAL 1 DAY)) AS DATE) AS day FROM u)"),
    "work_list": (
        "WITH inv AS (SELECT DISTINCT l_suppkey AS site_id, l_partkey AS inverter_id "
        "FROM lineitem), s AS (SELECT DISTINCT s_suppkey AS site_id FROM supplier) "
        "SELECT site_id, inverter_id, strftime(day, '%Y-%m-%d') AS day FROM (SELECT inv.site_id, inv.inverter_id, "
        f"CAST(unnest(range(TIMESTAMP '{d.WORK_START}', TIMESTAMP '{d.WORK_END}', "
        "INTERVAL 1 DAY)) AS DATE) AS day FROM inv JOIN s ON inv.site_id = s.site_id)"),
    "missing_user_days": (
        f"WITH {_USER_DAYS}, e AS (SELECT user_id, CAST(unnest(generate_series("
        "CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS day FROM u) "
        "SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM e WHERE NOT EXISTS (SELECT 1 FROM events v WHERE "
        "v.user_id = e.user_id AND CAST(v.ts AS DATE) = e.day)"),
    "known_users": ("SELECT c_custkey, c_name FROM customer WHERE EXISTS "
                    "(SELECT 1 FROM events WHERE events.user_id = customer.c_custkey)"),
    "compose_address": f"WITH {_SITES} SELECT c_custkey, query_address FROM sites",
    "geocode_match": (f"WITH {_SITES}, {_LOOKUP} SELECT c_custkey, sites.query_address, "
                      "address, latitude, longitude FROM sites JOIN lk "
                      "ON sites.query_address = lk.query_address"),
    "geocode_reject": (f"WITH {_SITES}, {_LOOKUP} SELECT c_custkey, query_address FROM sites "
                       "WHERE NOT EXISTS (SELECT 1 FROM lk WHERE "
                       "lk.query_address = sites.query_address)"),
    "cursor_last_event": (
        f"WITH pos AS ({_LAST.format(where='')}) SELECT c_custkey, pos.t AS last_type, "
        "strftime(coalesce(pos.d, DATE '2023-01-01'), '%Y-%m-%d') AS start_date FROM customer "
        "LEFT JOIN pos ON c_custkey = pos.user_id"),
    "cursor_upsert": (
        f"WITH o AS ({_LAST.format(where=f'WHERE ts < TIMESTAMP {chr(39)}{d.RANGE_END}{chr(39)}')}), "
        f"n AS ({_LAST.format(where=f'WHERE ts >= TIMESTAMP {chr(39)}{d.RANGE_END}{chr(39)}')}) "
        "SELECT coalesce(n.user_id, o.user_id) AS user_id, "
        "CASE WHEN n.user_id IS NOT NULL THEN n.t ELSE o.t END AS last_type, "
        "strftime(CASE WHEN n.user_id IS NOT NULL THEN n.d ELSE o.d END, '%Y-%m-%d') AS last_date "
        "FROM o FULL OUTER JOIN n ON o.user_id = n.user_id"),
    "day_ops": (
        f"SELECT o_orderkey, strftime(date_trunc('day', o_orderdate), {TS_FMT}) AS day_start, "
        f"strftime(date_trunc('day', o_orderdate) + INTERVAL '23:59:59', {TS_FMT}) AS day_end, "
        "strftime(CAST(o_orderdate AS DATE) + 1, '%Y-%m-%d') AS next_day, "
        f"strftime(try_strptime(strftime(o_orderdate, {TS_FMT}), {TS_FMT}), {TS_FMT}) AS parsed, "
        "CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, "
        "CAST(day(o_orderdate) AS INTEGER) AS d FROM orders"),
    "run_days": (
        "SELECT event_id, strftime(CASE WHEN strftime(ts, '%H:%M:%S') <= '00:20:00' "
        "THEN CAST(ts AS DATE) - 1 ELSE CAST(ts AS DATE) END, '%Y-%m-%d') AS cutoff_day, "
        "strftime(CASE WHEN CAST(ts - INTERVAL 30 MINUTE AS DATE) = CAST(ts AS DATE) "
        "THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END, '%Y-%m-%d') AS business_day "
        "FROM events"),
    "overview_kpis": " UNION ALL ".join(
        f"SELECT o_orderkey, CAST({i} AS BIGINT) AS \"Id\", strftime(o_orderdate, {TS_FMT}) "
        f"AS \"UpdateTimeUtc\", o_totalprice{div} AS \"Value\" FROM orders"
        for i, div in ((1, ""), (2, " / 10"), (3, " / 100"), (4, " / 1000"))),
    "power_series": (
        "SELECT vec_id, CAST(5 AS BIGINT) AS \"Id\", "
        "strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((i - 1) * 5 AS BIGINT)), "
        f"{TS_FMT}) AS \"UpdateTimeUtc\", CAST(x AS DOUBLE) AS \"Value\" FROM "
        "(SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i "
        "FROM embeddings)"),
    "energy_series": (
        "SELECT vec_id, CAST(6 AS BIGINT) AS \"Id\", "
        "strftime(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((i - 1) * 15 AS BIGINT)), "
        f"{TS_FMT}) AS \"UpdateTimeUtc\", CAST(x AS DOUBLE) * 1000 AS \"Value\" FROM "
        "(SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i "
        "FROM embeddings)"),
    "data_period": (
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') "
        "END AS start_date, CASE WHEN o_orderstatus <> 'P' THEN "
        "strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') END AS end_date FROM orders"),
}
