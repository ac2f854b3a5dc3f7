"""Property tests: Spark expressions against plain-Python models on generated inputs.
Each example batch is one DataFrame, so one Spark job checks many cases."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from heliolake.functions import dates as fd
from heliolake.functions.address import compose_address
from heliolake.operators import export

DAYS = st.dates(min_value=dt.date(2019, 12, 25), max_value=dt.date(2021, 1, 5))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(DAYS, DAYS), min_size=1, max_size=30))
def test_date_range_matches_half_open_model(spark, pairs):
    df = spark.createDataFrame(pairs, "s date, e date")
    got = df.select("s", "e", fd.date_range("s", "e").alias("r"),
                    fd.catch_up_range(F.col("s"), F.col("e")).alias("c")).collect()
    for r in got:
        n = (r["e"] - r["s"]).days
        assert r["r"] == [r["s"] + dt.timedelta(days=i) for i in range(max(n, 0))]
        assert r["c"] == [r["s"] + dt.timedelta(days=i) for i in range(max(n + 1, 0))]


def _model_address(a2, a, city):
    a2, a, city = a2 or "", a or "", city or ""
    if a2 != "":
        return f"{a2} {a} {city}"
    if a != "":
        return f"{a} {city}"
    return city


PART = st.one_of(st.none(), st.just(""), st.text(alphabet="ab ק", min_size=1, max_size=4))


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(PART, PART, PART), min_size=1, max_size=30))
def test_compose_address_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "a2 string, a string, c string")
    for r in df.select("a2", "a", "c", compose_address("a2", "a", "c").alias("q")).collect():
        assert r["q"] == _model_address(r["a2"], r["a"], r["c"])


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-1e6, 1e6)),
                          st.one_of(st.none(), st.floats(-1e6, 1e6))), min_size=1, max_size=25))
def test_melt_keeps_every_cell(spark, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                               "id int, a double, b double")
    long = export.melt_measures(export.fill_zero(df, ["a", "b"]), ["id"], ["a", "b"])
    assert long.count() == 2 * len(rows)
    assert long.filter(F.col("measure_value").isNull()).count() == 0
