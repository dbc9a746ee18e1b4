"""Set operations (U1-U3). ``UNION ALL`` is a narrow concatenation (no
shuffle); ``UNION`` adds one hash aggregate on all columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    """``UNION ALL`` matched by column name (U1, U2). The sources' unions are
    positional with both sides in the same order, so by-name is the same
    result and safe against reordering."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """``SELECT DISTINCT * FROM (a UNION ALL b)`` = ``UNION``."""
    return union_all(*dfs).distinct()
