"""Session defaults shared by jobs and tests.

The settings below are the ones the data model depends on, not tuning knobs:

* ``spark.sql.session.timeZone=UTC``: telemetry ``Datetime`` strings carry no zone; epoch
  export (P17) must not depend on the machine's zone.
* ``partitionOverwriteMode=dynamic``: ``write_day`` replaces only the days it writes.
* ``partitionColumnTypeInference.enabled=false``: ``inv_id=73E4`` and ``inv_id=0012``
  must stay strings (decimal inference turns them into 730000 and 12).
* AQE on, so shuffle partition counts adapt to the real data size at run time and skewed
  join partitions are split.

``apply_defaults`` also sets ``parallelPartitionDiscovery.parallelism`` from the cores. Spark lists
a landing with a folder per inverter in one job per parent folder and by default starts a task
for each of up to 10,000 folders of it, so tasks would be as many as inverter-days.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.json.filterPushdown.enabled": "true",
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.sources.parallelPartitionDiscovery.threshold": "8",
}

LISTING_TASKS_PER_CORE = 4


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to an existing session."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(LISTING_TASKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return spark


def build_session(master: str | None = None, app_name: str = "heliolake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the heliolake defaults.

    ``master`` is only set when given: on a cluster the submitter decides it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests) may go without: it gets a private folder. On a cluster a
    missing setting is an error, as no machine-local folder is shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not master.startswith("local") or "cluster" in master:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    local = tempfile.mkdtemp(prefix="heliolake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path for intermediate data below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
