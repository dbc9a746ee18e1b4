"""Label and category mappings as JVM-side CASE expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade labels and their ordinals, as the source maps them.
GRADE_ORDINALS = {
    "PreK": -1,
    "Kindergarten": 0,
    "First": 1,
    "Second": 2,
    "Third": 3,
    "Fourth": 4,
    "Fifth": 5,
    "Sixth": 6,
    "Seventh": 7,
    "Eighth": 8,
    "Ninth": 9,
    "Tenth": 10,
    "Eleventh": 11,
    "Twelfth": 12,
    "Other": 13,
}
GRADE_LABELS = tuple(GRADE_ORDINALS)

# Strand ids per lesson subject.
SUBJECT_STRANDS = {
    "Language": (13, 7),
    "Literacy": (4, 8),
    "Grammar": (14,),
}
LESSON_STRANDS = (4, 8, 13, 7, 14)


def map_values(col: Column, mapping: dict, default=None) -> Column:
    """``CASE col WHEN k1 THEN v1 ... ELSE default END`` built from a dict.
    Unknown labels (and NULL) give ``default``."""
    items = list(mapping.items())
    first_k, first_v = items[0]
    expr = F.when(col == F.lit(first_k), F.lit(first_v))
    expr = reduce(lambda e, kv: e.when(col == F.lit(kv[0]), F.lit(kv[1])), items[1:], expr)
    return expr.otherwise(F.lit(default)) if default is not None else expr


def grade_to_int(col: str | Column) -> Column:
    """Sixteen-way grade label to ordinal; anything else is NULL (P10)."""
    c = F.col(col) if isinstance(col, str) else col
    return map_values(c, GRADE_ORDINALS).cast("int")


def subject_of(strand: str | Column) -> Column:
    """Strand id to 'Language' / 'Literacy' / 'Grammar' / 'Other' (X20)."""
    s = F.col(strand) if isinstance(strand, str) else strand
    expr = None
    for name, ids in SUBJECT_STRANDS.items():
        cond = s.isin(*ids)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("Other")


def lesson_number(strand: str | Column, order_id: str | Column, base_strand: int = 4,
                  offset: int = 16) -> Column:
    """``CASE WHEN strand = 4 THEN order ELSE 16 + order END``."""
    s = F.col(strand) if isinstance(strand, str) else strand
    o = F.col(order_id) if isinstance(order_id, str) else order_id
    return F.when(s == base_strand, o).otherwise(F.lit(offset) + o)


def nz(col: str | Column, zero=0) -> Column:
    """``CASE WHEN x IS NULL THEN 0 ELSE x END``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(zero))
