"""Silver / gold Parquet tables partitioned by ``dt``.

Day windows are resolved to partition folders *before* the scan: one listing of the
table root gives the ``dt=`` folder names, the window keeps the wanted ones, and only
those folders are handed to the reader (with ``basePath`` so ``dt`` stays a column).
A path-based table otherwise lists every file of every day when the DataFrame is
created, which for years of history costs more than the day being processed. The
``dt`` predicate is still applied on top, so results never depend on the listing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Folder value for NULL and empty partition values.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _lit_day(d) -> Column:
    if isinstance(d, Column):
        return d
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.lit(str(d))


def _day_str(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        return d.strftime("%Y-%m-%d")
    return str(d)


def day_filter(d, column: str = "dt") -> Column:
    """``dt = 'd'`` (F1). ``dt`` is a string partition value, so this is partition pruning."""
    return F.col(column) == _lit_day(d)


def day_range_filter(column: str | Column, start, end) -> Column:
    """Half-open ``start <= column < end`` (S5). On a string ``dt`` partition column the
    ISO format makes lexicographic order equal date order, so both bounds prune
    partitions; on a timestamp column both bounds are pushed to the Parquet reader."""
    c = F.col(column) if isinstance(column, str) else column
    return (c >= _lit_day(start)) & (c < _lit_day(end))


@dataclass(frozen=True)
class DayOf:
    """The day of a timestamp column where a table has no ``dt`` (F1).

    Predicates are ranges on the column itself (``ts >= d AND ts < d + 1``), not on a computed
    day, so both bounds reach the Parquet reader and row groups of other days are skipped."""
    column: str

    def on(self, d) -> Column:
        day = _dt.date.fromisoformat(_day_str(d)[:10])
        return self.between(day, day + _dt.timedelta(days=1))

    def between(self, start, end) -> Column:
        """Half-open: ``start <= day < end``."""
        at = [F.lit(f"{_day_str(x)[:10]} 00:00:00").cast("timestamp") for x in (start, end)]
        return (F.col(self.column) >= at[0]) & (F.col(self.column) < at[1])

    def value(self) -> Column:
        return F.date_format(self.column, "yyyy-MM-dd")


def on_day(day: str | DayOf, d) -> Column:
    """``day = d`` for a ``dt`` column or the day of a timestamp."""
    return day.on(d) if isinstance(day, DayOf) else day_filter(_day_str(d), day)


def any_day(day: str | DayOf, days: Sequence) -> Column:
    """``day IN (days)``."""
    if not isinstance(day, DayOf):
        return F.col(day).isin([_day_str(d) for d in days])
    out = F.lit(False)
    for d in days:
        out = out | day.on(d)
    return out


def day_value(day: str | DayOf) -> Column:
    return day.value() if isinstance(day, DayOf) else F.col(day)


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return bool(fs.exists(p))


def path_keys(spark: SparkSession, root: str, folders: Sequence[str] | None = None) -> list[str]:
    """Keys of the ``key=value`` folders above the first file below ``root`` (or its ``folders``)."""
    _, top = hadoop_path(spark, root)
    depth = len(top.toUri().getPath().rstrip("/").split("/"))
    for folder in folders or [root]:
        fs, p = hadoop_path(spark, folder)
        files = fs.listFiles(p, True) if fs.exists(p) else None  # goes down folder by folder
        while files is not None and files.hasNext():
            *above, name = files.next().getPath().toUri().getPath().split("/")[depth:]
            hidden = [x for x in (*above, name) if x[0] == "." or (x[0] == "_" and "=" not in x)]
            if not hidden:
                return [x.split("=", 1)[0] for x in above if "=" in x]
    return []


def path_value(key: str, path: str = "_metadata.file_path") -> Column:
    """The value of ``key=value`` in a file's path, as Spark's partition discovery gives it.

    For a landing with a folder per inverter: discovery guesses at the type of each folder's value by
    failed parses and resolves the values of n folders in time that grows as n * n, on the driver.
    Here each task takes the values out of its own files' paths, and filters on them still leave
    files unopened. ``_metadata.file_path`` is URL-encoded, another ``path`` is taken as it is."""
    found = F.regexp_extract(path, f"^.*/{key}=([^/]*)/", 1)
    for _ in range(2 if path == "_metadata.file_path" else 1):
        found = F.coalesce(F.try_url_decode(F.replace(found, F.lit("+"), F.lit("%2B"))), found)
    return F.when(~found.isin("", NO_VALUE), found).alias(key)


def day_folders(spark: SparkSession, root: str, dt=None, start=None, end=None,
                column: str = "dt", days=None) -> list[str] | None:
    """Partition folders of ``root`` inside the window (one day, ``[start, end)`` or an
    explicit set of ``days``), from a single listing of the root (names only, no file
    listing). ``None`` when no window is given."""
    if days is not None:
        wanted = {_day_str(d) for d in days}
        fs, p = hadoop_path(spark, root)
        if not fs.exists(p) or not wanted:
            return []
        prefix = f"{column}="
        return sorted(st.getPath().toString() for st in fs.listStatus(p)
                      if st.isDirectory() and st.getPath().getName().startswith(prefix)
                      and st.getPath().getName()[len(prefix):] in wanted)
    if dt is None and (start is None or end is None):
        return None
    fs, p = hadoop_path(spark, root)
    if not fs.exists(p):
        return []
    prefix = f"{column}="
    lo, hi = (_day_str(dt), None) if dt is not None else (_day_str(start), _day_str(end))
    keep = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(prefix)):
            continue
        v = name[len(prefix):]
        if (hi is None and v == lo) or (hi is not None and lo <= v < hi):
            keep.append(st.getPath().toString())
    return sorted(keep)


def _window_filter(dt=None, start=None, end=None, column: str = "dt",
                   days=None) -> Column | None:
    if days is not None:
        return F.col(column).isin([_day_str(d) for d in days])
    if dt is not None:
        return day_filter(dt, column)
    if start is not None and end is not None:
        return day_range_filter(column, start, end)
    return None


def read_parquet_window(spark: SparkSession, root: str, dt=None, start=None, end=None,
                        days=None, schema: StructType | None = None) -> DataFrame:
    """A ``dt`` partitioned Parquet table restricted to one day or ``[start, end)``; only
    ``*.parquet`` objects are read (S7). A window without days gives an empty DataFrame with
    ``schema``, else with that of the table's newest day; no other file is listed for it. A
    given ``schema`` spares the look into a file footer and stands in for an absent table."""
    folders = day_folders(spark, root, dt, start, end, days=days)
    reader = spark.read.option("pathGlobFilter", "*.parquet").option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    if folders:
        df = reader.parquet(*folders)
    elif folders is None:
        df = reader.parquet(root)
    else:
        if schema is None:
            newest = day_folders(spark, root, start="", end="\uffff")
            if not newest:
                raise FileNotFoundError(f"no day folders under {root}")
            schema = reader.parquet(newest[-1]).schema
        return spark.createDataFrame([], schema)
    cond = _window_filter(dt, start, end, days=days)
    return df.filter(cond) if cond is not None else df


def read_table(spark: SparkSession, path: str, dt=None) -> DataFrame:
    """One day of a ``dt``-partitioned Parquet table (S4), or the whole table."""
    return read_parquet_window(spark, path, dt=dt)


def read_table_range(spark: SparkSession, path: str, start, end) -> DataFrame:
    """Days in ``[start, end)`` (S5) in one scan: a single distributed plan over the range
    instead of one job per day."""
    return read_parquet_window(spark, path, start=start, end=end)


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Expose a ``dt`` partitioned folder as a catalog table (external, data stays where it
    is) and register its partitions, so SQL users and partition pruning through the
    catalog see the same data as path readers."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
    repair_partitions(spark, name)
    return spark.table(name)


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register partitions written straight to storage (S8): ``MSCK REPAIR TABLE``.

    Only needed for catalog tables; path-based reads discover partitions themselves.
    """
    spark.catalog.recoverPartitions(table)
