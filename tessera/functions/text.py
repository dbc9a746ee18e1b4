"""String predicates and campaign-id extraction.

Everything here is a built-in Column expression, so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def like_ci(col: str | Column, pattern: str) -> Column:
    """Case-insensitive ``LIKE`` (the T-SQL pipelines' default collation)."""
    return _c(col).ilike(pattern)


def not_like_ci(col: str | Column, pattern: str) -> Column:
    """Case-insensitive ``NOT LIKE``; NULL input stays NULL, so a WHERE drops it."""
    return ~_c(col).ilike(pattern)


def like(col: str | Column, pattern: str) -> Column:
    return _c(col).like(pattern)


def ltrim_set(col: str | Column, chars: str) -> Column:
    """Strip leading characters that belong to the set ``chars`` (not a prefix):
    ``ltrim('cmp-123', 'cmp-')`` is ``'123'`` and ``ltrim('mc-9', 'cmp-')`` is ``'9'``."""
    return F.ltrim(_c(col), F.lit(chars))


# The campaign-id patterns of the source query.
CMP_PATTERN = "cmp-([0-9]{1,12})"
DIGITS_PATTERN = "^([0-9])+_*"


def regex_whole(col: str | Column, pattern: str) -> Column:
    """``REGEXP_SUBSTR(s, p)``: the whole first match, ``''`` when none."""
    return F.regexp_extract(_c(col), pattern, 0)


def campaign_from(sub: str | Column) -> Column:
    """Campaign id in one sub-id: the digits after ``cmp-`` when the text
    contains ``cmp``, else its leading digits (underscores removed)."""
    s = _c(sub)
    return (F.when(s.like("%cmp%"), ltrim_set(regex_whole(s, CMP_PATTERN), "cmp-"))
            .otherwise(F.replace(regex_whole(s, DIGITS_PATTERN), F.lit("_"), F.lit(""))))


def campaign_id(sub4: str | Column, sub3: str | Column) -> Column:
    """Nested CASE: sub4 when it is not NULL (even when empty), else sub3."""
    s4 = _c(sub4)
    return F.when(s4.isNotNull(), campaign_from(s4)).otherwise(campaign_from(sub3))
