"""Writers and partition lifecycle (K1, K2, K4-K6).

``write_day`` is the only way facts are written: a dynamic partition overwrite, so a
rerun of a day (hourly refresh, backfill, retried task) replaces exactly the days present
in the DataFrame and leaves every other day untouched. No ``coalesce(1)`` and no
repartition by ``dt``: funnelling a whole day into one task would make the largest day
the bottleneck; each task writes its own file per day it holds instead, and
``maxRecordsPerFile`` bounds file size.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from heliolake.sinks.document_sink import land_documents
from heliolake.sources.tables import day_folders, hadoop_path


def write_day(df: DataFrame, path: str, partition_cols: Sequence[str] = ("dt",),
              max_records_per_file: int = 5_000_000, fmt: str = "parquet",
              distribute: str | None = None, num_partitions: int | None = None) -> None:
    """Idempotent overwrite of the partitions present in ``df`` (K1).

    ``distribute`` says how rows reach the writing tasks:

    * ``None`` (default): as they are. Right when the input is already clustered by day
      (bronze and silver files each hold one day), so no shuffle is spent.
    * ``"rebalance"``: a ``REBALANCE`` hint on the partition columns for large input that
      is not clustered by day. AQE sizes the write tasks from runtime statistics and
      splits a skewed day (one day holding a third of the rows) over many tasks.
    * ``"hash"``: a fixed-count hash repartition on the partition columns, for small
      outputs such as per-day aggregates: AQE would coalesce those into one task that then
      commits every day folder by itself, and a fixed count is never coalesced.
      ``num_partitions`` (e.g. the number of days written) caps the task count.
    """
    if distribute == "rebalance":
        df = df.hint("rebalance", *partition_cols)
    elif distribute == "hash":
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(max(1, min(n, num_partitions or n)), *partition_cols)
    elif distribute is not None:
        raise ValueError(f"distribute must be None, 'rebalance' or 'hash', not {distribute!r}")
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", max_records_per_file)
       .partitionBy(*partition_cols)
       .format(fmt)
       .save(path))


def replace_day(df: DataFrame, path: str, day, max_records_per_file: int = 5_000_000) -> None:
    """Overwrite of one day's folder (K1), also when ``df`` has no rows: the day is then empty,
    where a dynamic overwrite would leave what an earlier run wrote. All rows must be of
    ``day``; other days are not touched. The rows are written to a side folder, which readers
    skip, and take the day's place by a rename when they are whole: a failed run leaves the day
    as it was. Between the two renames the day is not there; a ``DayTable`` has no such moment."""
    spark, root = df.sparkSession, path.rstrip("/")
    fs, new = hadoop_path(spark, f"{root}/_new-{day}-{uuid.uuid4().hex[:8]}")
    try:
        (df.drop("dt").write.option("maxRecordsPerFile", max_records_per_file)
           .parquet(new.toString()))
    except BaseException:
        fs.delete(new, True)
        raise
    _, there = hadoop_path(spark, f"{root}/dt={day}")
    _, old = hadoop_path(spark, f"{root}/_old-{day}-{uuid.uuid4().hex[:8]}")
    moved = fs.exists(there)
    if moved and not fs.rename(there, old):
        raise OSError(f"cannot set {there.toString()} aside")
    if not fs.rename(new, there):
        if moved:
            fs.rename(old, there)
        raise OSError(f"cannot put the new rows at {there.toString()}")
    if moved:
        fs.delete(old, True)


def _names(fs, folder) -> set[str]:
    return {st.getPath().getName() for st in fs.listStatus(folder)}


def write_window(df: DataFrame, path: str, start=None, end=None, days=None, within=None,
                 **how) -> list[str]:
    """``write_day`` for a range or set of days, after which days of the window that got no
    rows are removed, as an overwrite day by day would empty them. ``within`` restricts the
    removal to these days. A replaced folder holds none of its earlier files, so a folder that
    still does got no rows; it goes only after the write has succeeded. Returns those days."""
    spark = df.sparkSession
    before = {}
    for folder in day_folders(spark, path, start=start, end=end, days=days) or []:
        fs, p = hadoop_path(spark, folder)
        before[folder] = _names(fs, p)
    write_day(df, path, **how)
    gone = []
    for folder, names in before.items():
        day = folder.rstrip("/").rsplit("dt=", 1)[1]
        fs, p = hadoop_path(spark, folder)
        if (within is None or day in within) and fs.exists(p) and _names(fs, p) & names:
            fs.delete(p, True)
            gone.append(day)
    return gone


def spread_folders(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one folder in one task, the folders dealt over all tasks. For layouts with a
    folder per inverter: there the time goes into making folders and files, not into bytes, and
    tasks sized by bytes (``rebalance``) would leave all folders to one of them. A fixed count
    is never coalesced."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def land_bronze_json(df: DataFrame, root: str,
                     partition_cols: Sequence[str] = ("dt", "site_id", "inv_id"),
                     rebalance: bool = True, compression: str = "none") -> None:
    """Land documents as JSON Lines under ``dt=/site_id=/inv_id=`` (K2). Spark names the
    files itself (no ':' from a time of day, which Hadoop paths reject). Documents come
    from any source order, so they are rebalanced on the partition columns first (AQE
    sizes the tasks and splits hot days); with a folder per inverter, the folders are spread
    over the tasks. Tasks move their files into the staging folder of the write (committer
    version 2), so the driver only puts whole folders in place. A folder that receives
    documents is replaced whole: land whole inverter-days, as a part of a day would remove its
    other readings. ``compression`` (``gzip``) suits folders of many documents; every reader
    takes it from the file name. Folders per inverter on a local file system are written by
    ``land_documents``, to the same rules."""
    if rebalance and "inv_id" in partition_cols:
        df = spread_folders(df, *partition_cols)
    elif rebalance:
        df = df.hint("rebalance", *partition_cols)
    fs, p = hadoop_path(df.sparkSession, root)
    if "inv_id" in partition_cols and compression == "none" and fs.getUri().getScheme() == "file":
        return land_documents(df, fs.makeQualified(p).toUri().getPath(), *partition_cols)
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
       .partitionBy(*partition_cols)
       .json(root, compression=compression))


_STANDARD_CHARSETS = {"iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32",
                      "utf-8"}


def write_sites_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Header CSV of site locations (K4). UTF-8 by default; a legacy single-byte charset
    such as windows-1255 needs ``spark.sql.legacy.javaCharsets``, which is on for this write
    only, and writes '?' for characters it cannot map, like the original export."""
    conf, flag = df.sparkSession.conf, "spark.sql.legacy.javaCharsets"
    before = conf.get(flag, "false")
    try:
        if encoding.lower() not in _STANDARD_CHARSETS:
            conf.set(flag, "true")
        (df.write.mode("overwrite").option("header", "true").option("encoding", encoding)
           .csv(path))
    finally:
        conf.set(flag, before)


def drop_previous_snapshot(spark: SparkSession, path_or_table: str, day,
                           keep_days: int = 1) -> bool:
    """Retention of a *dimension* snapshot table (K5): after day ``d`` was written, drop
    partition ``dt = d - keep_days``. Call only after the write of ``d`` succeeded; fact
    tables are never passed here. Works on a catalog table (``ALTER TABLE ... DROP``) or a
    storage path (Hadoop FileSystem delete of the ``dt=`` directory)."""
    d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
    old = (d - _dt.timedelta(days=keep_days)).isoformat()
    if "/" not in path_or_table and spark.catalog.tableExists(path_or_table):
        spark.sql(f"ALTER TABLE {path_or_table} DROP IF EXISTS PARTITION (dt='{old}')")
        return True
    fs, part = hadoop_path(spark, f"{path_or_table.rstrip('/')}/dt={old}")
    if fs.exists(part):
        return bool(fs.delete(part, True))
    return False


def truncate_then_load(df: DataFrame, path: str, is_dimension: bool = True) -> None:
    """Older full-refresh variant (K6): static overwrite of the whole table. Only for
    dimension tables; fact tables must use ``write_day`` so history is never wiped."""
    if not is_dimension:
        raise ValueError("truncate_then_load is for dimension tables; use write_day for facts")
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if "dt" in df.columns:
        w = w.partitionBy("dt")
    w.parquet(path)
