"""Incremental bookkeeping as tables (X2, X4, C1-C4, D1/D2 applied to rows).

Work lists and cursors are DataFrames: the expected (site, inverter, day) grid is an
equi-join of the inventory with the site list followed by a per-row ``explode`` of a day
sequence; cursors are small keyed tables updated by union + ``max_by``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from heliolake.functions.dates import DEFAULT_START_DATE, catch_up_range, date_range
from heliolake.schemas import CURSOR
from heliolake.sources.tables import hadoop_path, path_exists


def work_list(sites: DataFrame, inventory: DataFrame, start, end,
              site_key: str = "site_id", inverter_key: str = "inverter_id") -> DataFrame:
    """Expected (site, inverter, day) for days in [start, end) (X2 + D1).

    ``sites`` and ``inventory`` are joined on the site key (inner: only listed sites);
    Spark picks broadcast for a small site list from runtime statistics (AQE), else a
    shuffle join. Each inventory row then expands to its days without any cross join.
    """
    inv = inventory.select(site_key, inverter_key)
    listed = sites.select(site_key).distinct()
    return (inv.join(listed, site_key, "inner")
               .select(site_key, inverter_key, F.explode(date_range(start, end)).alias("day")))


def missing_work(expected: DataFrame, landed: DataFrame,
                 keys=("site_id", "inverter_id", "day")) -> DataFrame:
    """Expected work not landed yet (C4): ``left_anti`` on all keys."""
    return expected.join(landed.select(*keys).distinct(), list(keys), "left_anti")


def empty_cursor(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CURSOR)


def known_keys(items: DataFrame, index: DataFrame, key: str = "site_id",
               known: bool = True) -> DataFrame:
    """Membership test ``key in index`` (F4): ``left_semi`` keeps items whose key is in
    the index, ``left_anti`` (``known=False``) the new ones. Neither multiplies rows."""
    return items.join(index.select(key).distinct(), key, "left_semi" if known else "left_anti")


def cursor_read(cursor: DataFrame, key: str = "site_id") -> DataFrame:
    """Latest position per key (C2): the row with the highest ``seq`` (NULL ranks lowest), of
    those the one with the latest date, then the highest serial number. With its ``moment``
    where the cursor has that column."""
    order = F.struct(F.coalesce("seq", F.lit(-1)), "last_date", "serial_number")
    kept = ["serial_number", "last_date", *[c for c in ("moment",) if c in cursor.columns]]
    return (cursor.groupBy(key)
                  .agg(F.max_by(F.struct(*kept), order).alias("p"), F.max("seq").alias("seq"))
                  .select(key, "p.serial_number", "p.last_date", "seq",
                          *[f"p.{c}" for c in kept[2:]]))


def cursor_upsert(cursor: DataFrame, updates: DataFrame, key: str = "site_id",
                  update_order: str | None = None) -> DataFrame:
    """Set or replace the position of each updated key.

    Old rows and updates are unioned and reduced per key; an update always wins over the
    stored position and gets ``seq = stored seq + 1`` (per key, so no global counter and
    no join is needed). A new key is inserted with its date, not an empty string. Columns are
    merged one by one: an update without a serial number keeps the stored one, one without a
    ``moment`` the stored moment. Among several updates of a key the last by ``update_order`` (a
    column of ``updates``) wins, else the latest date.
    """
    timed = "moment" in cursor.columns or "moment" in updates.columns
    for name, kind in (("serial_number", "string"), *([("moment", "timestamp")] if timed else [])):
        if name not in updates.columns:
            updates = updates.withColumn(name, F.lit(None).cast(kind))
        if name not in cursor.columns:
            cursor = cursor.withColumn(name, F.lit(None).cast(kind))
    moment = ["moment"] if timed else []
    turn = F.col(update_order).cast("bigint") if update_order else F.lit(0).cast("bigint")
    old = cursor.select(key, "serial_number", *moment, "last_date", "seq",
                        F.lit(0).alias("is_update"), F.lit(0).cast("bigint").alias("turn"))
    new = updates.select(F.col(key).cast("string").alias(key), "serial_number", *moment,
                         F.col("last_date").cast("date").alias("last_date"),
                         F.lit(None).cast("bigint").alias("seq"), F.lit(1).alias("is_update"),
                         turn.alias("turn"))
    order = F.struct("is_update", "turn", F.coalesce("seq", F.lit(0)), "last_date",
                     "serial_number")
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
              for c in ("serial_number", *moment)]
    return (old.unionByName(new)
               .groupBy(key)
               .agg(F.max_by("last_date", order).alias("last_date"), *latest,
                    F.coalesce(F.max("seq"), F.lit(0)).alias("top"),
                    F.max("is_update").alias("updated"))
               .select(key, "serial_number", "last_date",
                       (F.col("top") + F.col("updated")).cast("bigint").alias("seq"), *moment))


def cursor_lookup(sites: DataFrame, cursor: DataFrame, key: str = "site_id",
                  default: str = DEFAULT_START_DATE) -> DataFrame:
    """Start date per site (X4): a known site resumes at its ``last_date``; an unknown
    site (or a NULL date) starts at ``default``."""
    pos = cursor_read(cursor, key).select(key, "last_date")
    return (sites.join(pos, key, "left")
                 .withColumn("start_date",
                             F.coalesce(F.col("last_date"), F.lit(default).cast("date"))))


def catch_up_work(sites: DataFrame, cursor: DataFrame, as_of, key: str = "site_id",
                  default: str = DEFAULT_START_DATE) -> DataFrame:
    """(site, day) still to pull, from the cursor's last date through ``as_of`` inclusive
    (D2 + X4)."""
    looked = cursor_lookup(sites, cursor, key, default)
    return looked.select(key, F.explode(catch_up_range(F.col("last_date"), as_of, default))
                         .alias("day"))


def islands(days: DataFrame, key: str = "site_id", day: str = "day") -> DataFrame:
    """Stretches of consecutive days per key: (key, first_day, last_day, n_days).

    Within a key the distinct days are numbered in order; day minus number is the same for all
    days of a stretch. The distinct step is an aggregation with a partial stage, so many rows of
    one (key, day) cost one; the window then holds one key's days, a few thousand at most. NULL
    days are no days."""
    numbered = days.select(key, F.col(day).cast("date").alias("day")).filter(
        "day IS NOT NULL").distinct().withColumn(
        "_n", F.row_number().over(Window.partitionBy(key).orderBy("day")))
    return (numbered.groupBy(key, F.date_sub("day", F.col("_n")).alias("_stretch"))
            .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"),
                 F.count(F.lit(1)).cast("int").alias("n_days")).drop("_stretch"))


def advance_cursor(cursor: DataFrame, landed: DataFrame, until, moment=None,
                   key: str = "site_id", day: str = "day", default: str = DEFAULT_START_DATE
                   ) -> DataFrame:
    """Updates that move each key's position over the days that landed without a gap.

    A known key goes on from its ``last_date``, a new one from the day before ``default``; it
    moves to the last day of the stretch of ``landed`` (key, day) rows up to ``until`` that joins
    on. Days behind a gap do not move it: they are taken up when the gap is filled. Only keys
    that move are returned: (key, last_date, open_days, moment), where ``open_days`` counts the
    days up to ``until`` that have not landed. Feed them to ``cursor_upsert``.
    """
    until = until if isinstance(until, F.Column) else F.lit(until)
    until = until.cast("date")
    at = cursor_read(cursor, key).select(key, F.col("last_date").alias("_at"))
    here = landed.select(key, F.col(day).cast("date").alias("day")).filter(F.col("day") <= until)
    start = F.coalesce("_at", F.date_sub(F.lit(default).cast("date"), 1))
    known = here.join(at, key, "left").filter(F.col("day") > start)
    # the position itself counts as landed, also when its files are archived
    held = known.select(key, "day").unionByName(known.select(key, start.alias("day")))
    stretches = islands(held, key)
    return (stretches.join(at, key, "left")
            .groupBy(key)
            .agg(F.max(F.when(F.col("first_day") == start, F.col("last_day"))).alias("last_date"),
                 F.first(start).alias("_start"),
                 (F.datediff(until, F.first(start)) + 1 - F.sum("n_days")).cast("int")
                 .alias("open_days"))
            .filter(F.col("last_date") > F.col("_start"))
            .select(key, "last_date", "open_days",
                    F.lit(moment).cast("timestamp").alias("moment")))


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The stored cursor table: its newest complete version, or an empty cursor."""
    done = _versions(spark, path)
    return spark.read.schema(CURSOR).parquet(done[-1][1]) if done else empty_cursor(spark)


def write_cursor(cursor: DataFrame, path: str) -> None:
    """Store a new version of the cursor beside the old one, so that a cursor may be computed
    from the version it replaces and a failed write leaves that in force. The version before
    stays for readers at work; older ones go."""
    spark = cursor.sparkSession
    done = _versions(spark, path)
    number = done[-1][0] + 1 if done else 1
    cursor.write.mode("overwrite").parquet(f"{path.rstrip('/')}/v{number:012d}")
    for _, old in done[:-1]:
        fs, p = hadoop_path(spark, old)
        fs.delete(p, True)


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    out = []
    for st in fs.listStatus(root):
        name, where = st.getPath().getName(), st.getPath().toString()
        if name[:1] == "v" and name[1:].isdigit() and path_exists(spark, f"{where}/_SUCCESS"):
            out.append((int(name[1:]), where))
    return sorted(out)


def run_marker(spark: SparkSession, now: _dt.datetime, key: str = "now") -> DataFrame:
    """Run-start boundary row (C3), to union into a cursor table as ``site_id = 'now'``: the day
    and the moment (date and time; with a zone, that instant) of the run."""
    return spark.createDataFrame([(key, None, now.date(), 0, now)], CURSOR)
