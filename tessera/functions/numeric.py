"""Casts and ratio rules.

The sources promote to decimals with ``1.0 *``; the scale of such decimals
differs between engines, so ratios are computed as double here. Money is
summed as exact decimal and only the total converted, which makes totals
independent of summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(col: str | Column) -> Column:
    """``CAST(x AS float)`` / ``1.0 * x``."""
    return _c(col).cast("double")


def typed_null(type_name: str = "decimal(38,9)") -> Column:
    """``CAST(NULL AS NUMERIC)`` (P5)."""
    return F.lit(None).cast(type_name)


def per_unit(total: Column, units: float) -> Column:
    """Unit conversion after SUM: seconds / 60.0, cents / 100."""
    return total.cast("double") / F.lit(float(units))
