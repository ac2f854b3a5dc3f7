"""Date and incremental-bookkeeping expressions.

All are built-in Spark functions so they run per row inside codegen; day lists are
``sequence`` arrays meant to be exploded next to the rows that need them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and defaults used by the bronze documents and the cursors.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DEFAULT_START_DATE = "2023-01-01"
CUTOFF_TIME = "00:20:00"


def _date(c) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, (_dt.date, _dt.datetime)):
        return F.lit(c.strftime("%Y-%m-%d")).cast("date")
    if isinstance(c, str):
        # a literal 'YYYY-MM-DD' or a column name
        if len(c) == 10 and c[4] == "-" and c[7] == "-":
            return F.lit(c).cast("date")
        return F.col(c)
    raise TypeError(f"not a date or column: {c!r}")


def _empty_dates() -> Column:
    return F.array().cast("array<date>")


def date_range(start, end) -> Column:
    """Half-open day list [start, end) as ``array<date>``.

    ``sequence(a, b)`` counts *down* when b < a, so an empty range must be guarded:
    start >= end gives an empty array, never a reversed one.
    """
    s, e = _date(start), _date(end)
    return F.when(s < e, F.sequence(s, F.date_sub(e, 1))).otherwise(_empty_dates())


def catch_up_range(last_date, as_of, default: str = DEFAULT_START_DATE) -> Column:
    """Inclusive day list from the cursor's last date (or ``default``) to ``as_of``.

    The last fetched day is fetched again on purpose (it may have been partial). Empty
    when the cursor is already past ``as_of``.
    """
    s = F.coalesce(_date(last_date), F.lit(default).cast("date"))
    e = _date(as_of)
    return F.when(s <= e, F.sequence(s, e)).otherwise(_empty_dates())


def business_day(today, last_run_day) -> Column:
    """Day the hourly run works on (D3): a second run on the same day keeps today; the
    first run of a new day closes yesterday."""
    t, last = _date(today), _date(last_run_day)
    return F.when(last == t, t).otherwise(F.date_sub(t, 1))


def cutoff_day(now_ts, cutoff: str = CUTOFF_TIME) -> Column:
    """Older rule (D4): runs up to ``cutoff`` after midnight still belong to yesterday."""
    ts = F.col(now_ts) if isinstance(now_ts, str) else now_ts
    d = F.to_date(ts)
    return F.when(F.date_format(ts, "HH:mm:ss") <= F.lit(cutoff), F.date_sub(d, 1)).otherwise(d)


def day_bounds(ts) -> tuple[Column, Column]:
    """(00:00:00, 23:59:59) of the day of ``ts``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    start = F.date_trunc("day", ts)
    return start, start + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def next_day(d) -> Column:
    """Calendar next day, across month and year ends and leap days."""
    return F.date_add(_date(d), 1)


def parse_datetime(s, fmt: str = DATETIME_FORMAT) -> Column:
    """Strict parse of a reading time; an invalid string becomes NULL."""
    s = F.col(s) if isinstance(s, str) else s
    return F.try_to_timestamp(s, F.lit(fmt))


def parse_day(s, fmt: str = DATE_FORMAT) -> Column:
    s = F.col(s) if isinstance(s, str) else s
    return F.to_date(F.try_to_timestamp(s, F.lit(fmt)))


def date_parts(s) -> tuple[Column, Column, Column]:
    """(year, month, day) ints from a 'Y-M-D...' string (D8): split on '-', the day keeps
    its leading 1-2 digits (so '2023-01-05 10:00:00' gives day 5). Missing or unreadable
    parts are NULL."""
    s = F.col(s) if isinstance(s, str) else s
    parts = F.split(s, "-")
    year = F.get(parts, F.lit(0)).try_cast("int")
    month = F.get(parts, F.lit(1)).try_cast("int")
    day = F.regexp_extract(F.get(parts, F.lit(2)), r"^(\d{1,2})", 1).try_cast("int")
    return year, month, day
