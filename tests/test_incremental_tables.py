"""Late days, hash-first duplicates, derived days, hot-key geocoding, average states, changed
files, the record sink and shape drift."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

import fixtures
from heliolake.operators import address, agg_state, incremental, quality, shapes
from heliolake.operators import gold as gold_ops
from heliolake.plans import pipeline as P
from heliolake.sinks import DayTable, read_records, replace_day, write_records
from heliolake.sinks.record_sink import committed_files
from heliolake.sources import bronze
from heliolake.sources.tables import DayOf
from heliolake.streaming import start_change_refresh


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- C3, C4 ------------------------------------------------------------------------------

def _land(root, day, site="1", inv="07", energy=1.0, name="a"):
    folder = os.path.join(root, "inverters_data", f"dt={day}", f"site_id={site}", f"inv_id={inv}")
    os.makedirs(folder, exist_ok=True)
    doc = {"data": {"telemetries": [fixtures.reading(f"{day} 10:00:00", 1.0, 1.0, 1.0, energy)]}}
    with open(os.path.join(folder, f"{name}.json"), "w") as f:
        f.write(json.dumps(doc) + "\n")


def test_day_that_lands_late_is_taken_up(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in ("b", "s", "g", "e")])
    cursor = str(tmp_path / "c")
    run = lambda *at: P.hourly_run(spark, lay, cursor, dt.datetime(*at), (P.INVERTERS,))
    mark = lambda: incremental.cursor_read(incremental.read_cursor(spark, cursor).filter(
        "site_id = 'now'")).first()
    with pytest.raises(FileNotFoundError):
        run(2024, 3, 1, 9)  # the first run closes the day before, which has not landed
    incremental.write_cursor(incremental.run_marker(spark, dt.datetime(2024, 3, 1, 9)), cursor)
    _land(lay.bronze, "2024-03-01")
    assert run(2024, 3, 1, 23) == ["2024-03-01"]
    assert mark().moment == dt.datetime(2024, 3, 1, 23)
    _land(lay.bronze, "2024-03-03")
    assert run(2024, 3, 4, 0, 10) == ["2024-03-01", "2024-03-03"]  # day 2 has not landed
    assert mark().last_date == dt.date(2024, 3, 1)
    assert [r.day for r in P.open_days(spark, lay, cursor, "2024-03-03").collect()] == [dt.date(2024, 3, 2)]
    assert run(2024, 3, 4, 1) == []  # nothing new; closed days are not repeated
    _land(lay.bronze, "2024-03-02")
    assert run(2024, 3, 4, 2) == ["2024-03-02"]
    assert mark().last_date == dt.date(2024, 3, 3)
    _land(lay.bronze, "2024-03-04")
    assert run(2024, 3, 4, 3) == ["2024-03-04"] == run(2024, 3, 4, 4)
    assert run(2024, 3, 5, 0, 5) == ["2024-03-04"]  # closes it
    days = {r.dt for r in spark.read.parquet(lay.g(P.INVERTERS)).select("dt").collect()}
    assert days == {f"2024-03-0{d}" for d in (1, 2, 3, 4)}


def test_site_positions_stop_at_their_own_gap(spark, tmp_path):
    lay, cursor = P.Layout(str(tmp_path / "b"), "s", "g"), str(tmp_path / "c")
    for site, days in (("1", (1, 2, 3)), ("2", (1, 3)), ("3", (2,))):
        for d in days:
            _land(lay.bronze, f"2024-03-0{d}", site)
    start = spark.createDataFrame([(s, None, dt.date(2024, 2, 29), 1, None) for s in "123"],
                                  incremental.CURSOR)
    incremental.write_cursor(start, cursor)
    moved = P.site_positions(spark, lay, cursor, dt.datetime(2024, 3, 3, 12))
    got = {r.site_id: (r.last_date.day, r.open_days) for r in moved.collect()}
    assert got == {"1": (3, 0), "2": (1, 1)}  # site 3 has no day 1
    _land(lay.bronze, "2024-03-02", "2")
    P.site_positions(spark, lay, cursor, dt.datetime(2024, 3, 3, 13))
    at = {r.site_id: str(r.last_date) for r in incremental.read_cursor(spark, cursor).collect()}
    assert at == {"1": "2024-03-03", "2": "2024-03-03", "3": "2024-02-29"}


def test_islands_against_brute_force(spark):
    rng = random.Random(4)
    base = dt.date(2024, 1, 1)
    rows = [(str(rng.randint(0, 9)), base + dt.timedelta(days=rng.randint(0, 40))) for _ in range(300)]
    rows += [("x", None)]
    got = sorted((r.site_id, r.first_day, r.last_day, r.n_days) for r in incremental.islands(
        spark.createDataFrame(rows, "site_id string, day date")).collect())
    want = []
    for key in sorted({k for k, d in rows if d}):
        days = sorted({d for k, d in rows if k == key and d})
        first = last = days[0]
        for d in days[1:] + [None]:
            if d is None or (d - last).days != 1:
                want.append((key, first, last, (last - first).days + 1))
                first = d
            last = d
    assert got == sorted(want)


# -- Q6-Q8, F1 ---------------------------------------------------------------------------

def test_duplicate_counts_are_exact(spark, monkeypatch):
    nan = float("nan")
    rows = [(1, None, "a", 0.0), (1, "a", None, 0.0), (1, "a", None, -0.0), (2, "b", "c", nan),
            (2, "b", "c", nan), (3, None, None, None), (3, None, None, None), (4, "d", "e", 1.0)]
    df = spark.createDataFrame(rows, "k int, `odd.name` string, t string, v double")
    assert quality.duplicate_counts(df) == (8, df.distinct().count()) == (8, 5)
    assert quality.duplicate_counts(df.limit(0)) == (0, 0)
    assert quality.duplicate_counts(df, ["k"]) == (8, 4)
    # rows that share a hash without being equal are told apart by all columns
    monkeypatch.setattr(quality, "row_hash", lambda cols: [F.lit(1).cast("long"), F.lit(2).cast("long")])
    assert quality.duplicate_counts(df) == (8, 5)
    monkeypatch.setattr(quality, "SUSPECTS", 0)  # more suspects than may be broadcast
    assert quality.duplicate_counts(df) == (8, 5)


def test_day_of_a_timestamp_is_pushed_down(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, d, h), f"u{h}") for d in (1, 2, 3) for h in (0, 12, 23)]
    spark.createDataFrame(rows, "ts timestamp, u string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    one = df.filter(DayOf("ts").on("2024-01-02"))
    plan = _plan(one)
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan and one.count() == 3
    row = quality.coverage_check(df, "u", "2024-01-04", "c", "m", DayOf("ts")).first()
    assert (row.observed, row.expected, row.passed) == (3, 3, True)
    assert quality.freshness_check(df, "2024-01-09", "f", "m", DayOf("ts")).first().passed is False


# -- X3 ----------------------------------------------------------------------------------

def test_geocode_hot_keys_and_ambiguous(spark):
    sites = [(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(3000)] + [(9000, None), (9001, "")]
    lookup = [("hot", "H", 1.0, 2.0), ("k1", "A", 1.0, 1.0), ("k1", "B", 2.0, 2.0), ("k2", "C", 3.0, 3.0),
              ("k2", "C", 3.0, 3.0), ("unused", "U", 0.0, 0.0), (None, "N", 0.0, 0.0)]
    s = spark.createDataFrame(sites, "id int, query_address string")
    lk = spark.createDataFrame(lookup, "query_address string, address string, latitude double, longitude double")
    for share in (1 / 1000, 0.1, 2.0):  # all keys hot, one hot, none hot
        for mode in ("first", "reject"):
            got = {r.id: (r.address, r.hit, r.reason)
                   for r in address.geocode_locate(s, lk, ambiguous=mode, hot_share=share).collect()}
            assert len(got) == len(sites)
            for i, key in sites:
                want = {"hot": ("H", True, None), "k2": ("C", True, None),
                        "k1": ("A", True, None) if mode == "first" else (None, False, "ambiguous")}
                assert got[i] == want.get(key, (None, False, "no hit")), (i, key, share, mode)
    matched, rejected = address.geocode_join(s, lk, ambiguous="reject")
    assert matched.count() + rejected.count() == len(sites)
    assert {r.reason for r in rejected.select("reason").collect()} == {"no hit", "ambiguous"}


def test_geocode_shuffles_the_sites_once(spark):
    s = spark.range(1000).select("id", F.concat(F.lit("k"), F.col("id") % 7).alias("query_address"))
    lk = spark.createDataFrame([("k1", "A", 1.0, 1.0)],
                               "query_address string, address string, latitude double, longitude double")
    plan = _plan(address.geocode_locate(s, lk))
    sides = [p for p in plan.split("Exchange hashpartitioning")[1:] if "_spread" in p.split("\n")[0]]
    assert len(sides) <= 2  # the sites and the keys; none where the keys are broadcast


# -- A1, ST1 -----------------------------------------------------------------------------

def _gold(spark, rows):
    cols = "dt string, Local_site_id string, Local_inverter_id string, Account_id string, " \
           "Data_Source string, DC_Current double, v double, w double"
    return spark.createDataFrame(rows, cols)


def test_state_merge_equals_full_recompute(spark):
    rng = random.Random(7)

    def reading(day, inv):
        return (f"2024-01-0{day}", f"s{inv % 2}", f"i{inv}", None, "x", rng.choice([None, 1.0]),
                rng.choice([None, 1.5, 2.0]), None)
    first = [reading(d, i) for d in (1, 2) for i in range(6) for _ in range(5)]
    late = [reading(2, i) for i in (1, 7) for _ in range(4)]  # one corrected, one new inverter
    m = ["v", "w"]
    states = agg_state.average_states(_gold(spark, first), measures=m)
    new = agg_state.average_states(_gold(spark, late), measures=m)
    merged = agg_state.averages(agg_state.merge_states(states, new), measures=m)
    whole = [r for r in first if not (r[0] == "2024-01-02" and r[2] == "i1")] + late
    full = gold_ops.inverter_agg(_gold(spark, whole), measures=m)
    key = lambda r: (r.dt, str(r.DC_Current))
    got = {key(r): (r.v and round(r.v, 9), r.w) for r in merged.collect()}
    assert got == {key(r): (r.v and round(r.v, 9), r.w) for r in full.collect()}


def _files(*roots):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for root in roots
            for d, _, names in os.walk(os.path.join(root, "data")) for f in names if f.endswith(".parquet")}


def test_late_file_replaces_its_slot_only(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in ("b", "s", "g", "e")], versioned=True, slots=8)
    days = ("2024-03-01", "2024-03-02")
    for d in days:
        for i in range(12):
            _land(lay.bronze, d, str(i % 3), f"{i:02d}", float(i))
    run = lambda: start_change_refresh(spark, lay, str(tmp_path / "ckpt")).awaitTermination()
    run()
    tables = [lay.s(P.INVERTERS), lay.g(P.INVERTERS), lay.g(P.STATES), lay.export]
    before, seen = _files(*tables), {t: lay.day_table(spark, t).units().collect() for t in tables}
    _land(lay.bronze, days[1], "1", "04", 100.0, "late")  # a second file of one inverter-day
    run()
    after = _files(*tables)
    assert {f: t for f, t in after.items() if f in before} == before  # nothing rewritten
    for t in tables:
        now = lay.day_table(spark, t).units().collect()
        old = {(r.dt, r.slot): r.commit for r in seen[t]}
        changed = {(r.dt, r.slot) for r in now if old.get((r.dt, r.slot)) != r.commit}
        assert len(changed) == 1 and next(iter(changed))[0] == days[1], t
    # the tables equal a full run
    full = P.Layout(lay.bronze, *[str(tmp_path / f"full{x}") for x in "sge"])
    P.history_run(spark, full, days[0], "2024-03-03", (P.INVERTERS,))
    for path in (P.Layout.s, P.Layout.g):
        x, y = (P.read_window(spark, lo, path(lo, P.INVERTERS)) for lo in (lay, full))
        assert x.exceptAll(y.select(*x.columns)).count() == 0 and x.count() == y.count() == 25
    x, y = ({r.dt: round(r.AC_Energy, 9) for r in P.read_window(spark, lo, lo.g(P.AGG)).collect()}
            for lo in (lay, full))
    assert x == y
    # a history run on the same layout keeps slots and states
    P.history_run(spark, lay, days[0], "2024-03-03", (P.INVERTERS,))
    z = {r.dt: round(r.AC_Energy, 9) for r in P.read_window(spark, lay, lay.g(P.AGG)).collect()}
    assert z == y


def test_failed_day_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    day = spark.createDataFrame([(1, "2024-01-01")], "x int, dt string")
    replace_day(day, path, "2024-01-01")
    bad = day.withColumn("x", F.expr("CASE WHEN x = 1 THEN raise_error('lost') ELSE x END"))
    with pytest.raises(Exception, match="lost"):
        replace_day(bad, path, "2024-01-01")
    assert [r.x for r in spark.read.parquet(path).collect()] == [1]
    assert [f for f in os.listdir(path) if not f.startswith(".")] == ["dt=2024-01-01"]


def test_compacted_landing_equals_the_files(spark, tmp_path):
    root = str(tmp_path / "b")
    fixtures.write_inverters(root)
    landing = os.path.join(root, "inverters_data")
    t = DayTable(spark, str(tmp_path / "docs"))
    bronze.compact_landing(spark, landing, t, start=fixtures.D1, end="2022-12-03")
    for window in (dict(), dict(dt=fixtures.D2), dict(start=fixtures.D1, end=fixtures.D2)):
        x = bronze.read_compacted(t, **window)
        y = bronze.read_inverter_bronze(spark, landing, **window)
        assert x.columns == y.columns
        assert sorted(map(str, x.collect())) == sorted(map(str, y.collect()))


def test_catalog_and_cutoff(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in ("b", "s", "g", "e")])
    _land(lay.bronze, "2024-03-01")
    assert P.cutoff_run(spark, lay, dt.datetime(2024, 3, 2, 0, 10), (P.INVERTERS,)) == "2024-03-01"
    spark.sql("CREATE DATABASE IF NOT EXISTS hl_refresh")
    try:
        names = P.refresh_tables(spark, lay, "hl_refresh")
        assert len(names) == 4 and spark.table("hl_refresh.gold_inverters_data").count() == 1
        _land(lay.bronze, "2024-03-02")
        assert P.cutoff_run(spark, lay, dt.datetime(2024, 3, 2, 9), (P.INVERTERS,)) == "2024-03-02"
        assert P.refresh_tables(spark, lay, "hl_refresh") == names
        assert spark.table("hl_refresh.gold_inverters_data").count() == 2
    finally:
        spark.sql("DROP DATABASE hl_refresh CASCADE")


# -- K3, S10 -----------------------------------------------------------------------------

def test_record_sink_survives_a_failed_run(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = [("Solar Edge", f"s,{i}", f"i={i} \\x\nnew", f"m{i % 3}", i / 7, i * 1000) for i in range(50)]
    rows += [(None, "s", "", "m", -1e-300, -5), ("d", "s", "i", None, 1.0, 1), ("d", "s", "i", "m", None, 1)]
    df = spark.createDataFrame(rows, "data_source string, local_site_id string, local_inverter_id string, "
                               "measure_name string, measure_value double, time long").repartition(4)
    bad = df.withColumn("measure_value", F.expr(
        "CASE WHEN time = 49000 THEN raise_error('lost') ELSE measure_value END"))
    with pytest.raises(Exception, match="lost"):
        write_records(bad, path, "day-1")
    assert committed_files(path) == {} and read_records(spark, path).count() == 0
    for _ in range(2):  # the repeated run, and once more
        write_records(df, path, "day-1")
    want = sorted(r for r in rows if r[3] is not None and r[4] is not None and r[0] is not None)
    got = read_records(spark, path)
    assert sorted(tuple(r)[1:] for r in got.filter("data_source IS NOT NULL").collect()) == want
    assert tuple(got.filter("data_source IS NULL").first()) == ("day-1", None, "s", "", "m", -1e-300, -5)
    names = committed_files(path)["day-1"]
    assert {f for f in os.listdir(os.path.join(path, "runs", "day-1")) if f[0] != "."} == set(names)
    write_records(df, path, "day-2")
    assert read_records(spark, path).groupBy("run").count().count() == 2


def test_shape_drift(spark, tmp_path):
    schema = StructType([StructField("m", StructType([StructField("v", DoubleType())])),
                         StructField("n", LongType()), StructField("s", StringType())])
    docs = {"a/dt=1": [{"m": {"v": 1.5}, "n": 1, "s": "x"}, {"m": {"v": 2}, "n": None, "s": "y"}],
            "a/dt=2": [{"m": {"v": "off"}, "n": 2, "s": "x", "new": [1]}], "a/dt=3": ["broken"]}
    for folder, items in docs.items():
        os.makedirs(tmp_path / folder)
        for k, doc in enumerate(items):
            (tmp_path / folder / f"{k}.json").write_text(doc[:2] if doc == "broken" else json.dumps(doc))
    raw = bronze.read_raw_landing(spark, str(tmp_path / "a")).withColumn("vendor", F.lit("a"))
    prof = {r.dt: r for r in shapes.shape_profile(raw).collect()}
    assert prof["2"].n_not_json == 0 and "new" in prof["2"].shape and prof["3"].n_not_json == 1
    drift = shapes.shape_drift(raw, schema)
    bad = {(r.dt, r.field) for r in drift.filter("unfit > 0").collect()}
    assert bad == {("2", "$['m']['v']")}
    got = {r.check: (r.passed, r.observed) for r in shapes.drift_check(drift).collect()}
    assert got == {"shape a 1": (True, 0), "shape a 2": (False, 1), "shape a 3": (True, 0)}
