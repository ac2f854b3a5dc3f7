"""Data-quality checks (Q1-Q9): each check is a one-row DataFrame
``(check, passed, observed, expected, message)``; a report is their union.

Checks are Spark jobs over whole tables: the coverage checks scan only the two days they
compare (``dt IN (d-1, d-2)``, partition pruned) in a single pass instead of two scalar
subqueries joined by a cross join; the duplicate checks count 128-bit row hashes and compare
whole rows only where a hash occurs twice.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from heliolake.session import scratch_dir
from heliolake.sources.tables import DayOf, any_day, day_value, on_day

CHECK_COLUMNS = ["check", "passed", "observed", "expected", "message"]


def _day(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        return d.strftime("%Y-%m-%d")
    return str(d)


def _days_before(as_of, n: int) -> str:
    d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(_day(as_of))
    return (d - _dt.timedelta(days=n)).isoformat()


def _row(df: DataFrame, name: str, passed, observed, expected, message: str) -> DataFrame:
    return df.select(F.lit(name).alias("check"), passed.alias("passed"),
                     observed.cast("bigint").alias("observed"),
                     expected.cast("bigint").alias("expected"),
                     F.lit(message).alias("message"))


def coverage_check(df: DataFrame, column: str, as_of, name: str, message: str,
                   day_col: str | DayOf = "dt") -> DataFrame:
    """Distinct ``column`` values on d-1 must be >= those on d-2 (Q1, Q2). ``day_col`` is a
    partition column, or ``DayOf`` a timestamp column whose range is then pushed down."""
    d1, d2 = _days_before(as_of, 1), _days_before(as_of, 2)
    per_day = (df.filter(any_day(day_col, (d1, d2)))
                 .groupBy(day_value(day_col).alias("_day"))
                 .agg(F.count_distinct(column).alias("n")))
    agg = per_day.agg(
        F.coalesce(F.max(F.when(F.col("_day") == d1, F.col("n"))), F.lit(0)).alias("a"),
        F.coalesce(F.max(F.when(F.col("_day") == d2, F.col("n"))), F.lit(0)).alias("b"),
    )
    return _row(agg, name, F.col("a") >= F.col("b"), F.col("a"), F.col("b"), message)


def activity_checks(df: DataFrame, coverage: dict[str, tuple[str, str]], fresh: tuple[str, str],
                    as_of, day_col: str | DayOf = "dt") -> DataFrame:
    """Coverage of several columns (column -> check name, message) and freshness of one table
    (Q1-Q3) as one row each, from a single scan of the two days they look at."""
    d1, d2 = _days_before(as_of, 1), _days_before(as_of, 2)
    on = {d: on_day(day_col, d) for d in (d1, d2)}
    agg = df.filter(any_day(day_col, (d1, d2))).agg(
        F.count(F.when(on[d1], F.lit(1))).alias("n"),
        *[F.count_distinct(F.when(on[d], F.col(c))).alias(f"{x}{k}")
          for k, c in enumerate(coverage) for x, d in (("a", d1), ("b", d2))])

    def row(check, passed, observed, expected):
        name, message = check
        return F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                        observed.cast("bigint").alias("observed"),
                        expected.cast("bigint").alias("expected"), F.lit(message).alias("message"))

    rows = [row(check, F.col(f"a{k}") >= F.col(f"b{k}"), F.col(f"a{k}"), F.col(f"b{k}"))
            for k, check in enumerate(coverage.values())]
    rows.append(row(fresh, F.col("n") > 0, F.col("n"), F.lit(1)))
    return agg.select(F.inline(F.array(*rows)))


def freshness_check(df: DataFrame, as_of, name: str, message: str,
                    day_col: str | DayOf = "dt") -> DataFrame:
    """At least one row on d-1 (Q3-Q5)."""
    d1 = _days_before(as_of, 1)
    agg = df.filter(on_day(day_col, d1)).agg(F.count(F.lit(1)).alias("n"))
    return _row(agg, name, F.col("n") > 0, F.col("n"), F.lit(1), message)


#: Suspect hashes up to this number are broadcast to find their rows; more are joined by a shuffle.
SUSPECTS = 100_000


def row_hash(columns: Sequence[str]) -> list[F.Column]:
    """Two 64-bit hashes of a row. The second also covers which columns are NULL (a hash skips
    NULLs, so rows that differ in where they hold one would collide) and the reverse order."""
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns])
    cols = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(*cols), F.xxhash64(nulls, *reversed(cols))]


def duplicate_counts(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[int, int]:
    """``count(*)`` and ``count(DISTINCT *)`` of a table, exactly, without shuffling its rows.

    First the rows' 128-bit hashes are counted: 24 bytes a row are shuffled, exact copies within
    a task once. Hashes that occur once belong to distinct rows. The others are kept, and only
    where there are any the table is read again: their rows, found by the hash, are grouped by
    all columns, so rows that merely collide count as different. A table without copies is
    read once.
    """
    cols = list(columns or df.columns)
    first, second = row_hash(cols)
    hashed = df.select(first.alias("_h1"), second.alias("_h2"))
    groups = hashed.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_c"))
    seen = Observation()
    path = scratch_dir(df.sparkSession, "duplicates")
    (groups.observe(seen, F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"),
                    F.count(F.lit(1)).alias("hashes"),
                    F.count_if(F.col("_c") > 1).alias("suspect"))
     .filter("_c > 1").select("_h1", "_h2").write.parquet(path))
    rows, hashes, suspect = (int(seen.get[k]) for k in ("rows", "hashes", "suspect"))
    if not suspect:
        return rows, hashes
    keys = df.sparkSession.read.parquet(path)
    if suspect <= SUSPECTS:
        keys = F.broadcast(keys)
    whole = (df.select(*[F.col(f"`{c}`") for c in cols])
             .withColumn("_h1", first).withColumn("_h2", second)
             .join(keys, ["_h1", "_h2"], "left_semi"))
    distinct = whole.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.lit(1)).count()
    return rows, hashes - suspect + distinct


def duplicate_check(df: DataFrame, name: str, message: str,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """``count(*) = count(DISTINCT *)`` over the whole table (Q6-Q8), by ``duplicate_counts``,
    which runs here: the row returned holds its two numbers."""
    rows, distinct = duplicate_counts(df, columns)
    one = df.sparkSession.range(1)
    return _row(one, name, F.lit(rows == distinct), F.lit(rows), F.lit(distinct), message)


def report(checks: Sequence[DataFrame], failures_only: bool = False) -> DataFrame:
    """Union of one-row check results (Q9). ``failures_only`` keeps failed checks."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.filter(~F.col("passed")) if failures_only else out


class CheckFailed(RuntimeError):
    pass


def assert_report(report_df: DataFrame) -> None:
    """Raise when any check failed (the reference returned the exception class instead of
    raising it, so its checks never failed). The report has one row per check."""
    failed = report_df.filter(~F.col("passed")).select("check", "message").collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: {r['message']}" for r in failed))


# One message per check.
MESSAGES = {
    "inverter_coverage": "fewer inverters reported on the last day than on the day before (inverters_data)",
    "site_coverage": "fewer sites reported on the last day than on the day before (inverters_data)",
    "inverters_fresh": "no rows for the last day (inverters_data)",
    "inventory_fresh": "no rows for the last day (sites_invertory_details)",
    "sites_fresh": "no rows for the last day (sites_metadata)",
    "inverters_unique": "identical rows occur more than once (inverters_data)",
    "inventory_unique": "identical rows occur more than once (sites_invertory_details)",
    "sites_unique": "identical rows occur more than once (sites_metadata)",
}


def silver_checks(inverters: DataFrame, inventory: DataFrame, sites: DataFrame,
                  as_of) -> list[DataFrame]:
    """The eight checks on the three silver tables; the fact table is scanned twice, once for
    its last two days (Q1-Q3) and once over all days for duplicates (Q6)."""
    m = MESSAGES
    return [
        activity_checks(inverters, {
            "Local_inverter_id": ("inverter_coverage", m["inverter_coverage"]),
            "Local_site_id": ("site_coverage", m["site_coverage"])},
            ("inverters_fresh", m["inverters_fresh"]), as_of),
        freshness_check(inventory, as_of, "inventory_fresh", m["inventory_fresh"]),
        freshness_check(sites, as_of, "sites_fresh", m["sites_fresh"]),
        duplicate_check(inverters, "inverters_unique", m["inverters_unique"]),
        duplicate_check(inventory, "inventory_unique", m["inventory_unique"]),
        duplicate_check(sites, "sites_unique", m["sites_unique"]),
    ]
