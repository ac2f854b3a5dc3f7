"""Malformed, missing and ambiguous input: nothing aborts, nothing stale or arbitrary stays."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from heliolake.functions import dates, measures
from heliolake.operators import address, incremental, kpi
from heliolake.plans import pipeline as P
from heliolake.sinks import replace_day, write_sites_csv
from heliolake.sources import bronze


def test_unreadable_dates_become_null(spark):
    rows = spark.createDataFrame([("2024-01-05 10:00:00",), ("bad",), ("",), ("2024-x-05",), (None,)], "s string")
    got = rows.select(measures.epoch_millis("s"), *dates.date_parts("s")).collect()
    assert got[0][0] == 1704448800000 and tuple(got[0])[1:] == (2024, 1, 5)
    assert [r[0] for r in got[1:]] == [None] * 4
    assert tuple(got[3])[1:] == (2024, None, 5) and tuple(got[1])[1:] == (None, None, None)
    period = spark.createDataFrame([(("2024-01-01", "soon"),)], "dataPeriod struct<startDate:string,endDate:string>")
    assert tuple(kpi.data_period(period).first()) == (dt.date(2024, 1, 1), None)


def test_error_body_gives_no_overview_rows(spark):
    good = ("t", (1.0,), (2.0,), (3.0,), (4.0,))
    part = "struct<energy:double>"
    frame = spark.createDataFrame([(good,), (None,)], (
        f"overview struct<lastUpdateTime:string,lifeTimeData:{part},lastYearData:{part},"
        f"lastMonthData:{part},lastDayData:{part}>"))
    assert kpi.overview_kpis(frame).count() == 4


def test_cursor_merges_columns_and_reads_null_seq(spark):
    cur = spark.createDataFrame([("a", "SN9", dt.date(2024, 1, 1), 3)],
                                "site_id string, serial_number string, last_date date, seq long")
    new = spark.createDataFrame([("a", dt.date(2024, 1, 9), 1), ("a", dt.date(2024, 1, 5), 2)],
                                "site_id string, last_date date, turn_no int")
    out = incremental.cursor_upsert(cur, new, update_order="turn_no").first()
    assert (out.serial_number, out.last_date, out.seq) == ("SN9", dt.date(2024, 1, 5), 4)
    marker = incremental.run_marker(spark, dt.datetime(2024, 2, 3, 4))
    assert incremental.cursor_read(marker).first().last_date == dt.date(2024, 2, 3)
    null_seq = cur.withColumn("seq", F.lit(None).cast("long"))
    assert incremental.cursor_read(null_seq).first().last_date == dt.date(2024, 1, 1)


def test_ambiguous_lookup_is_deterministic(spark):
    sites = spark.createDataFrame([("x",)], "query_address string")
    lookup = spark.createDataFrame([("x", "B", 2.0), ("x", "A", 9.0)],
                                   "query_address string, address string, latitude double")
    for order in ("address", "latitude"):
        matched, _ = address.geocode_join(sites, lookup.orderBy(order))
        assert tuple(matched.first()) == ("x", "A", 9.0)


def test_inverter_list_keeps_its_site(spark, tmp_path):
    (tmp_path / "site_id=7").mkdir()
    (tmp_path / "site_id=7" / "a.json").write_text(json.dumps({"data": [{"id": "i1"}]}))
    assert [str(x) for x in bronze.read_inverter_list(spark, str(tmp_path)).first()] == ["7", "i1"]


def test_csv_charset_flag_is_restored(spark, tmp_path):
    before = spark.conf.get("spark.sql.legacy.javaCharsets", "false")
    write_sites_csv(spark.createDataFrame([("שלום",)], "name string"), str(tmp_path / "c"), "windows-1255")
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") == before


def test_rerun_without_rows_empties_the_day(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "x int, dt string")
    for day in ("2024-01-01", "2024-01-02"):
        replace_day(frame.filter(F.col("dt") == day), path, day)
    replace_day(frame.limit(0), path, "2024-01-01")
    assert [r.x for r in spark.read.parquet(path).collect()] == [2]


def _land(root, day, body, site="1"):
    folder = root / "inverters_data" / f"dt={day}" / f"site_id={site}" / "inv_id=07"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "a.json").write_text(body)


GOOD = '{"data": {"telemetries": [{"date": "2024-01-01 10:00:00", "totalEnergy": 1.0}]}}\n'


def test_range_rerun_removes_days_without_rows(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in ("b", "s", "g", "e", "r")])
    for day in ("2024-01-01", "2024-01-02"):
        _land(tmp_path / "b", day, GOOD)
    run = (spark, lay, "2024-01-01", "2024-01-04")
    P.history_run(*run, tables=(P.INVERTERS,))
    _land(tmp_path / "b", "2024-01-01", '{"data": {"telemetries": [{"da')
    P.history_run(*run, tables=(P.INVERTERS,))
    for path in (lay.s(P.INVERTERS), lay.g(P.INVERTERS), lay.g(P.AGG), lay.export):
        assert {r.dt for r in spark.read.parquet(path).select("dt").collect()} == {"2024-01-02"}
    reject = spark.read.parquet(lay.rejects).first()
    assert (reject.reason, reject.dt, reject.inv_id) == ("not JSON", "2024-01-01", "07")
    with pytest.raises(FileNotFoundError):  # a day that never landed is no empty day
        P.daily_run(spark, lay, "2024-01-03", tables=(P.INVERTERS,))


def test_documents_of_either_form(spark, tmp_path):
    (tmp_path / "lines.json").write_text(GOOD * 3)
    (tmp_path / "indented.json").write_text(
        "\n".join([json.dumps({"data": {"x": [{"y": 1}]}}, indent=4)] * 2))
    (tmp_path / "code.json").write_text("403\n")
    bodies = [r.body for r in bronze.read_json_documents(spark, str(tmp_path)).collect()]
    assert len(bodies) == 6 and all(json.loads(b) for b in bodies)


def test_cursor_versions(spark, tmp_path):
    path = str(tmp_path / "c")
    assert incremental.read_cursor(spark, path).count() == 0
    for day in (1, 2, 3):
        now = dt.datetime(2024, 5, day)
        old = incremental.read_cursor(spark, path)
        incremental.write_cursor(incremental.cursor_upsert(
            old, incremental.run_marker(spark, now).drop("seq")), path)
    assert incremental.read_cursor(spark, path).first().last_date == dt.date(2024, 5, 3)
    assert len(list((tmp_path / "c").glob("v*"))) == 2


def test_missing_bronze_and_empty_arguments_fail(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in ("no", "s", "g", "e")])
    with pytest.raises(FileNotFoundError):
        P.daily_run(spark, lay, "2024-01-01")
    with pytest.raises(SystemExit):
        P.job_main([])
