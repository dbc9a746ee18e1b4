"""Aggregate expressions.

All are built-in aggregate functions, so Spark runs them as partial (map
side) + final hash aggregation: a hot group is combined inside each task
before the shuffle and costs one row per task, not one per input row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera import fixed as fx


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: 0 for an empty match."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def pick(value: str | Column, cond: Column, empty=None) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE <empty> END)``: the value of the one
    row meeting ``cond``. ``empty=None`` gives NULL when no row does (A9),
    ``empty=0`` gives 0 (A10)."""
    v = F.when(cond, _c(value))
    if empty is not None:
        v = v.otherwise(F.lit(empty))
    return F.sum(v)


def activity_score(possible: str | Column, correct: str | Column, mastered: str | Column) -> Column:
    """``1.0 * SUM(CASE WHEN possible = 0 THEN mastered ELSE correct END)
    / SUM(CASE WHEN possible = 0 THEN 1 ELSE possible END)`` (A11): an item
    worth nothing scores its mastery flag out of 1."""
    p = _c(possible)
    num = F.sum(F.when(p == 0, _c(mastered)).otherwise(_c(correct)))
    den = F.sum(F.when(p == 0, F.lit(1)).otherwise(p))
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def rate(cond: Column) -> Column:
    """``1.0 * SUM(CASE WHEN cond THEN 1 ELSE 0 END) / COUNT(*)``."""
    return count_if(cond).cast("double") / F.count(F.lit(1))


def revenue_to_pace(date: str | Column, revenue: str | Column, kind: str | Column,
                    as_of: dt.date, excluded_kind: str = fx.W5_EXCLUDED_KIND) -> Column:
    """``SUM(CASE WHEN date = today THEN NULL WHEN kind != 'Addition' THEN
    revenue ELSE 0 END)`` (A17): today's partial day is left out; additions
    and rows of unknown kind count as 0."""
    d, k = _c(date), _c(kind)
    return F.sum(F.when(d == F.lit(as_of), F.lit(None))
                 .when(k != F.lit(excluded_kind), _c(revenue))
                 .otherwise(F.lit(0)))


def mean_exact(col: str | Column) -> Column:
    """``AVG`` over integers or decimals as exact sum / count in double, so it
    does not depend on the order rows are summed in. NULL for no values."""
    c = _c(col)
    n = F.count(c)
    return F.when(n > 0, F.sum(c).cast("double") / n)
