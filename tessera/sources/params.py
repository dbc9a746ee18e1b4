"""Typed parameters.

The source scripts declare session variables holding date strings and an
organisation id, and read ``current_date`` inside the queries. Here they are
plain arguments; ``as_of`` replaces ``current_date`` so results are stable.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from tessera.functions.dates import ntz


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


@dataclass(frozen=True)
class Params:
    """A reporting window and an organisation filter."""

    start: str
    end: str
    district: str

    @property
    def start_date(self) -> dt.date:
        return as_date(self.start)

    @property
    def end_date(self) -> dt.date:
        return as_date(self.end)

    def start_ts(self) -> Column:
        """The start string compared with a datetime means midnight of it."""
        return ntz(self.start_date)

    def end_ts(self, plus_days: int = 0) -> Column:
        """Midnight of ``end + plus_days`` (``DATEADD(dd, n, end)``)."""
        return ntz(self.end_date + dt.timedelta(days=plus_days))


# Parameters used by the registered queries on the stand-in tables. Each
# window covers the part of the driver data the pipeline's facts fall in.
ACTIVITY_PARAMS = Params("1997-01-01", "1997-12-31", "R1")
LESSON_PARAMS = Params("1997-01-01", "1998-06-30", "r1")
USAGE_PARAMS = Params("1998-01-01", "2024-01-20", "R1")
CAMPAIGN_FROM_DATE = "2023-01-01"
BUDGET_AS_OF = dt.date(1998, 6, 15)
