"""Work that must not grow with folders, micro-batches or measures."""

import glob
import os
import random

from pyspark.sql import functions as F

import fixtures
from heliolake.functions.measures import to_measure
from heliolake.operators import export as export_ops
from heliolake.plans import driver as D
from heliolake.plans import pipeline as P
from heliolake.plans import storage as S
from heliolake.session import LISTING_TASKS_PER_CORE, apply_defaults
from heliolake.sinks import land_bronze_json
from heliolake.sources import read_inverter_bronze
from heliolake.streaming import change_stream


def _docs(spark, n):
    reading = F.struct(F.lit("2024-03-01 10:00:00").alias("date"), F.col("id").cast("double").alias("totalEnergy"))
    return spark.range(0, n, 1, 1).select(
        F.struct(F.array(reading).alias("telemetries")).alias("data"), F.lit("2024-03-01").alias("dt"),
        (F.col("id") % 3).cast("string").alias("site_id"), F.lpad(F.col("id").cast("string"), 4, "0").alias("inv_id"))


def _tasks(root, suffix):
    found = glob.glob(f"{root}/**/part-*{suffix}", recursive=True)
    return len(found), len({os.path.basename(f).split("-")[1] for f in found})


def test_inverter_folders_are_written_by_many_tasks(spark, tmp_path):
    root = str(tmp_path / "land")
    land_bronze_json(_docs(spark, 60), root)
    files, tasks = _tasks(root, ".json")
    assert files == 60 and tasks > 1
    kept = glob.glob(f"{root}/dt=2024-03-01/site_id=0/inv_id=0003/*.json")
    land_bronze_json(_docs(spark, 60).filter("inv_id != '0003'").withColumn("data", F.lit(500)), root)
    assert glob.glob(f"{root}/dt=2024-03-01/site_id=0/inv_id=0003/*.json") == kept  # only what landed again
    assert _tasks(root, ".json")[0] == 60
    back = read_inverter_bronze(spark, root).filter("data IS NOT NULL").collect()
    assert [(r.inv_id, r.data.telemetries[0].totalEnergy) for r in back] == [("0003", 3.0)]
    assert not glob.glob(f"{root}/.spark-staging*")


def test_one_document_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    sf = str(tmp_path / "sf")
    spark.range(0, 40, 1, 1).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"),
        F.col("id").cast("double").alias("s_acctbal")).write.parquet(f"{sf}/supplier.parquet")
    monkeypatch.setattr(S, "_scratch", lambda spark, name: str(tmp_path / name))
    for name, query in (("pretty", S.q_pretty_overviews), ("raw", S.q_raw_landing)):
        found = query(spark, sf).select("s_suppkey").distinct().count()
        files, tasks = _tasks(tmp_path / name, ".txt")
        assert found == files == 40 and tasks > 1, name


def test_listing_tasks_follow_the_cores(spark):
    apply_defaults(spark)
    got = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    assert int(got) == LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def test_backlog_is_refreshed_once(spark, tmp_path, monkeypatch):
    lay = P.Layout(*[str(tmp_path / x) for x in "bsge"], versioned=True, slots=4)
    land_bronze_json(_docs(spark, 7), lay.b(P.INVERTERS))
    whole, calls = change_stream.refresh_units, []
    monkeypatch.setattr(change_stream, "refresh_units", lambda *a: (calls.append(1), whole(*a)))
    change_stream.start_change_refresh(spark, lay, str(tmp_path / "c"), max_files_per_trigger=3).awaitTermination()
    assert len(calls) == 1
    assert P.read_window(spark, lay, lay.g(P.INVERTERS)).count() == 7


def test_day_folders_are_landed_compressed(spark, tmp_path, monkeypatch):
    sf = str(tmp_path / "sf")
    spark.range(2000).select(
        F.lit(7).alias("l_suppkey"), F.col("id").alias("l_partkey"), (F.col("id") % 6 + 1).cast("int").alias("l_linenumber"),
        F.lit("1996-03-01").cast("date").alias("l_shipdate"),
        *[(F.col("id") % 9 + 1).cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
    ).write.parquet(f"{sf}/lineitem.parquet")
    monkeypatch.setattr(D, "_scratch", lambda spark, name: str(tmp_path / name))
    got, want = D.q_silver_from_landing(spark, sf), D.q_silver_inverters(spark, sf)
    assert got.count() == 2000 and got.select(*want.columns).exceptAll(want).count() == 0
    packed = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/landing/dt=*/*.json.gz"))
    land_bronze_json(D.telemetry_bronze(spark.read.parquet(f"{sf}/lineitem.parquet")), str(tmp_path / "plain"), ("dt",))
    plain = sum(os.path.getsize(f) for f in glob.glob(f"{tmp_path}/plain/dt=*/*.json"))
    assert 0 < packed < plain / 4


def test_measures_are_rounded_as_one_column(spark, tmp_path):
    fixtures.write_inverters(str(tmp_path))
    from heliolake.operators import gold, silver
    g = gold.gold_inverters(silver.flatten_telemetry(read_inverter_bronze(spark, f"{tmp_path}/inverters_data")))
    plan = export_ops.export_timeseries(g)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("round(") == 1


def test_to_measure_equals_round(spark):
    rnd = random.Random(5)
    xs = [0.0, -0.0, 0.0005, -0.0005, 1.0005, 2.5, 1.0045, -1.0045, 0.00049999999999999999, 1e9 + 0.0005, 999999999.9995,
          1e12, -1e15, 1.7e308, 5e-324, float("nan"), float("inf"), float("-inf"), None]
    xs += [rnd.uniform(-1, 1) * 10 ** rnd.randint(-6, 16) for _ in range(20000)]
    xs += [rnd.randint(-10**7, 10**7) / 10000 for _ in range(20000)]  # every tenth one a tie
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for scale in (0, 3, 6):
        a, b = to_measure("x", scale), F.round("x", scale)
        text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
        assert df.filter(text(a) != text(b)).collect() == [], scale


def test_merge_of_states_moves_each_state_once(spark):
    from heliolake.operators import agg_state
    from heliolake.schemas import AGG_KEYS, AGG_MEASURES
    cols = ["dt", *agg_state.UNIT, *AGG_KEYS, *AGG_MEASURES]
    row = lambda day, site, inv, x: spark.range(1).select(
        *[F.lit({"dt": day, "Local_site_id": site, "Local_inverter_id": inv}.get(c)).cast("string").alias(c)
          if c not in AGG_MEASURES else F.lit(x).cast("double").alias(c) for c in cols])
    old = row("a", "1", "x", 1.0).unionAll(row("a", None, "x", 2.0)).unionAll(row(None, "1", "x", 3.0)).unionAll(row("a", "2", "x", 4.0))
    new = row("a", None, "x", 20.0).unionAll(row(None, "1", "x", 30.0)).unionAll(row("b", "9", "y", 50.0))
    merged = agg_state.merge_states(agg_state.average_states(old), agg_state.average_states(new))
    got = sorted(r[f"sum_{AGG_MEASURES[0]}"] for r in merged.collect())
    assert got == [1.0, 4.0, 20.0, 30.0, 50.0]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    # the states once with all sums, the late ones with all sums and once by their ids alone
    assert plan.count(f"sum({AGG_MEASURES[0]}") == 2
