import datetime as dt

from pyspark.sql import functions as F

from heliolake.functions import dates as fd
from heliolake.operators import incremental as inc


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_date_range_half_open_and_guarded(spark):
    assert _one(spark, fd.date_range("2024-01-30", "2024-02-02")) == \
        [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert _one(spark, fd.date_range("2024-01-05", "2024-01-05")) == []
    assert _one(spark, fd.date_range("2024-01-05", "2024-01-03")) == []  # never counts down


def test_catch_up_inclusive_with_default(spark):
    assert _one(spark, fd.catch_up_range(F.lit(None).cast("date"), "2023-01-02")) == \
        [dt.date(2023, 1, 1), dt.date(2023, 1, 2)]
    assert _one(spark, fd.catch_up_range("2024-03-01", "2024-03-01")) == [dt.date(2024, 3, 1)]
    assert _one(spark, fd.catch_up_range("2024-03-02", "2024-03-01")) == []


def test_next_day_edges(spark):
    for d, n in (("2024-01-31", dt.date(2024, 2, 1)), ("2023-12-31", dt.date(2024, 1, 1)),
                 ("2024-02-28", dt.date(2024, 2, 29)), ("2023-02-28", dt.date(2023, 3, 1))):
        assert _one(spark, fd.next_day(d)) == n


def test_business_and_cutoff_day(spark):
    assert _one(spark, fd.business_day("2024-05-02", "2024-05-02")) == dt.date(2024, 5, 2)
    assert _one(spark, fd.business_day("2024-05-02", "2024-05-01")) == dt.date(2024, 5, 1)
    ts = F.lit("2024-05-02 00:19:59").cast("timestamp")
    assert _one(spark, fd.cutoff_day(ts)) == dt.date(2024, 5, 1)
    ts = F.lit("2024-05-02 00:20:01").cast("timestamp")
    assert _one(spark, fd.cutoff_day(ts)) == dt.date(2024, 5, 2)


def test_bounds_parse_parts(spark):
    s, e = fd.day_bounds(F.lit("2024-05-02 13:14:15").cast("timestamp"))
    assert _one(spark, F.date_format(e, fd.DATETIME_FORMAT)) == "2024-05-02 23:59:59"
    assert _one(spark, F.date_format(s, fd.DATETIME_FORMAT)) == "2024-05-02 00:00:00"
    assert _one(spark, fd.parse_datetime(F.lit("2024-13-40 99:00:00"))) is None
    y, m, d = fd.date_parts(F.lit("2023-1-5 10:00:00"))
    assert _one(spark, F.array(y, m, d)) == [2023, 1, 5]


def test_cursor_upsert_lookup_and_catch_up(spark):
    cur = spark.createDataFrame(
        [("s1", None, dt.date(2024, 1, 1), 1), ("s1", None, dt.date(2024, 1, 3), 2),
         ("s2", "SN2", None, 1)], "site_id string, serial_number string, last_date date, seq bigint")
    pos = {r["site_id"]: r for r in inc.cursor_read(cur).collect()}
    assert pos["s1"]["last_date"] == dt.date(2024, 1, 3)
    upd = spark.createDataFrame([("s2", dt.date(2024, 1, 2)), ("s3", dt.date(2024, 1, 4))],
                                "site_id string, last_date date")
    new = {r["site_id"]: r for r in inc.cursor_upsert(cur, upd).collect()}
    assert new["s2"]["last_date"] == dt.date(2024, 1, 2) and new["s2"]["seq"] == 2
    assert new["s3"]["last_date"] == dt.date(2024, 1, 4)  # a date, not ''
    assert new["s1"]["last_date"] == dt.date(2024, 1, 3)
    sites = spark.createDataFrame([("s1",), ("s2",), ("s9",)], "site_id string")
    look = {r["site_id"]: r["start_date"] for r in inc.cursor_lookup(sites, cur).collect()}
    assert look == {"s1": dt.date(2024, 1, 3), "s2": dt.date(2023, 1, 1),
                    "s9": dt.date(2023, 1, 1)}
    work = inc.catch_up_work(sites.filter(F.col("site_id") == "s1"), cur, "2024-01-05")
    assert [r["day"] for r in work.orderBy("day").collect()] == \
        [dt.date(2024, 1, d) for d in (3, 4, 5)]


def test_work_list_and_missing(spark):
    sites = spark.createDataFrame([("a",), ("b",)], "site_id string")
    inv = spark.createDataFrame([("a", "i1"), ("a", "i2"), ("c", "i3")],
                                "site_id string, inverter_id string")
    wl = inc.work_list(sites, inv, "2024-01-01", "2024-01-03")
    assert wl.count() == 4  # site c is not listed
    landed = spark.createDataFrame([("a", "i1", dt.date(2024, 1, 1))],
                                   "site_id string, inverter_id string, day date")
    assert inc.missing_work(wl, landed).count() == 3


def test_run_marker(spark):
    m = inc.run_marker(spark, dt.datetime(2024, 1, 2, 3, 4, 5)).first()
    assert m["site_id"] == "now" and m["last_date"] == dt.date(2024, 1, 2)


def test_known_keys(spark):
    items = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "site_id string, v int")
    idx = spark.createDataFrame([("a",), ("a",), ("c",)], "site_id string")
    assert sorted(r[0] for r in inc.known_keys(items, idx).collect()) == ["a", "c"]
    assert [r[0] for r in inc.known_keys(items, idx, known=False).collect()] == ["b"]
