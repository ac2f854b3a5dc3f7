"""Landings with a folder per inverter: no process a file, no partition discovery on the driver."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from heliolake.plans import pipeline as P
from heliolake.session import apply_defaults
from heliolake.sinks import DayTable, land_bronze_json
from heliolake.sources import (compact_landing, landed_partitions, read_compacted,
                               read_inverter_bronze, read_json_documents)
from heliolake.streaming import start_change_refresh

KEYS = ["dt", "site_id", "inv_id"]
ODD = ["a b", "a+b", "x:y", "50%", "ü/é", "0012", "73E4", None, "a%2Fb", "[q]", "=", "t\tt"]


def _docs(spark, ids, energy=0.0, day="2024-03-01"):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(ids)], "inv_id string, n int")
    reading = F.struct(F.lit(f"{day} 10:00:00").alias("date"), (F.col("n") + energy).alias("totalEnergy"))
    return rows.select(F.struct(F.array(reading).alias("telemetries")).alias("data"),
                       F.lit(day).alias("dt"), F.lit("s 1").alias("site_id"), "inv_id")


def _rows(df):
    return sorted(map(str, df.collect()))


def _folders(root):
    return sorted(os.path.relpath(d, root) for d, _, names in os.walk(root)
                  if any(n.endswith(".json") for n in names))


def _energies(spark, root):
    docs = read_inverter_bronze(spark, root).select("inv_id", F.explode("data.telemetries").alias("t"))
    return sorted(r[0] for r in docs.select("t.totalEnergy").collect())


def _path_columns_of_scan(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().partitionSchema().size()


def test_landing_equals_a_partitioned_write_without_checksums(spark, tmp_path):
    root, plain = str(tmp_path / "land"), str(tmp_path / "plain")
    land_bronze_json(_docs(spark, ODD), root)
    _docs(spark, ODD).write.partitionBy(*KEYS).json(plain)
    assert _folders(root) == _folders(plain)
    texts = lambda r: sorted(open(f).read() for f in glob.glob(f"{r}/*/*/*/*.json"))
    assert texts(root) == texts(plain)
    assert not [n for _, _, names in os.walk(root) for n in names if n.endswith(".crc")]
    assert not glob.glob(f"{root}/.*")


def test_landing_again_replaces_whole_folders_only(spark, tmp_path):
    root = str(tmp_path / "land")
    land_bronze_json(_docs(spark, ["a", "b", "b"]), root)
    assert _energies(spark, root) == [0.0, 1.0, 2.0]
    land_bronze_json(_docs(spark, ["b"], 9.0), root)
    assert _energies(spark, root) == [0.0, 9.0]
    # rows of one folder in several tasks all stay
    land_bronze_json(_docs(spark, ["b"] * 6, 20.0).repartition(3), root, rebalance=False)
    assert _energies(spark, root) == [0.0, 20.0, 21.0, 22.0, 23.0, 24.0, 25.0]


def test_failed_landing_leaves_the_landing_as_it_was(spark, tmp_path):
    root = str(tmp_path / "land")
    land_bronze_json(_docs(spark, ["a", "b", "c"]), root)
    bad = _docs(spark, ["a", "b", "c"], 50.0).withColumn("data", F.when(
        F.col("inv_id") == "b", F.raise_error(F.lit("cut"))).otherwise(F.to_json("data")))
    with pytest.raises(Exception, match="cut"):
        land_bronze_json(bad, root)
    assert _energies(spark, root) == [0.0, 1.0, 2.0]
    assert not glob.glob(f"{root}/.landing*")


def test_landed_folders_are_read_without_partition_discovery(spark, tmp_path):
    root, plain = str(tmp_path / "dt=0/land"), str(tmp_path / "plain")
    land_bronze_json(_docs(spark, ODD), root)
    _docs(spark, ODD).write.partitionBy(*KEYS).json(plain)
    found = landed_partitions(spark, root)
    assert _rows(found) == _rows(spark.read.format("binaryFile").load(plain).select(*KEYS).distinct())
    docs = read_inverter_bronze(spark, root)
    assert docs.columns == ["data", *KEYS]
    assert _rows(docs) == _rows(spark.read.schema(docs.schema).json(plain).select(*docs.columns))
    for df in (found, docs, read_json_documents(spark, root)):
        assert _path_columns_of_scan(df) == 0


def test_filter_on_path_values_leaves_files_unopened(spark, tmp_path):
    root = str(tmp_path / "land")
    land_bronze_json(_docs(spark, [f"{i:03d}" for i in range(30)]), root)
    one = read_inverter_bronze(spark, root, days=["2024-03-01"]).filter("inv_id = '007'")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    assert plan.collectLeaves().head().metrics().get("numFiles").get().value() == 1


def test_compaction_keeps_odd_ids(spark, tmp_path):
    root, table = str(tmp_path / "land"), DayTable(spark, str(tmp_path / "docs"))
    land_bronze_json(_docs(spark, ODD), root)
    land_bronze_json(_docs(spark, ["z"], 7.0, "2024-03-02"), root)
    compact_landing(spark, root, table, start="2024-03-01", end="2024-03-03")
    want = read_inverter_bronze(spark, root)
    assert _rows(read_compacted(table).select(*want.columns)) == _rows(want)


def test_change_stream_takes_ids_from_paths(spark, tmp_path):
    lay = P.Layout(*[str(tmp_path / x) for x in "bsge"], versioned=True, slots=4)
    ids = [x for x in ODD if x]
    land_bronze_json(_docs(spark, ids), lay.b(P.INVERTERS))
    query = start_change_refresh(spark, lay, str(tmp_path / "c"))
    query.awaitTermination()
    assert "ReadSchema: struct<path:string>" in query._jsq.explainInternal(True)
    gold = P.read_window(spark, lay, lay.g(P.INVERTERS))
    assert sorted(r[0] for r in gold.select("Local_inverter_id").collect()) == sorted(ids)


def test_small_files_share_tasks(spark, tmp_path):
    apply_defaults(spark)
    root = str(tmp_path / "land")
    land_bronze_json(_docs(spark, [str(i) for i in range(400)]), root)
    # 13 tasks at 4 MB an opened file
    assert read_inverter_bronze(spark, root).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism + 1
