"""Date predicates and date arithmetic.

Window predicates are written on the raw column against literals so they
become parquet ``PushedFilters``; functions of the column (``month(d) = 5``)
are evaluated after the scan and are used only where the source needs them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(value: dt.datetime | dt.date) -> Column:
    """A ``TIMESTAMP_NTZ`` literal built from text, so it does not depend on the
    Python process's or the session's time zone (a ``datetime`` literal would
    be converted through both)."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _midnight(day: dt.date | str) -> Column:
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return ntz(d)


def in_window(col: str | Column, start: dt.date | str, end: dt.date | str,
              end_plus_days: int = 0) -> Column:
    """``start <= ts <= end (+ n days)`` on a datetime; both bounds are midnight,
    so the closed upper bound keeps rows stamped exactly at midnight of the
    last day (F2, F3 with ``end_plus_days=1``)."""
    e = dt.date.fromisoformat(end) if isinstance(end, str) else end
    return (_c(col) >= _midnight(start)) & (_c(col) <= _midnight(e + dt.timedelta(days=end_plus_days)))


def between_dates(col: str | Column, start: dt.date | str, end: dt.date | str) -> Column:
    """``BETWEEN`` with date strings."""
    s = dt.date.fromisoformat(start) if isinstance(start, str) else start
    e = dt.date.fromisoformat(end) if isinstance(end, str) else end
    return _c(col).between(F.lit(s), F.lit(e))


def on_or_after(col: str | Column, day: dt.date | str) -> Column:
    """Lower bound only."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    return _c(col) >= F.lit(d)


def recent(col: str | Column, as_of: dt.date, months: int | None = None) -> Column:
    """``d BETWEEN d - 3 months AND today`` is ``d <= today`` (F16); pass
    ``months`` for the evident intent, a look-back of that many months."""
    c = _c(col)
    cond = c <= F.lit(as_of)
    if months is not None:
        cond = cond & (c >= F.add_months(F.lit(as_of), -months))
    return cond


def day_of_week(col: str | Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(col))


def add_years(col: str | Column, n: int = 1) -> Column:
    """``DATE_ADD(d, INTERVAL n YEAR)``: 29 February goes to 28 February."""
    return F.add_months(_c(col), 12 * n)


def year_start(day: dt.date) -> dt.date:
    """``DATE_TRUNC(d, YEAR)``."""
    return dt.date(day.year, 1, 1)


def year_end(day: dt.date) -> dt.date:
    """``LAST_DAY(d, YEAR)``."""
    return dt.date(day.year, 12, 31)


def year_start_col(col: str | Column) -> Column:
    return F.trunc(_c(col), "year")


def year_end_col(col: str | Column) -> Column:
    return F.make_date(F.year(_c(col)), F.lit(12), F.lit(31))
