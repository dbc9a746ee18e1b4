"""Key constraints as data-quality reports.

Spark does not enforce primary or foreign keys; these jobs find the rows a
database would have rejected. Each is one aggregate or one anti join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Primary-key violations: keys held by more than one row, with the count
    (D12). Partial aggregation folds a hot key inside each task."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``NOT NULL`` check (D13): one row per column with its NULL count, from a
    single aggregate over the table."""
    agg = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign-key violations (D14, D16): child rows whose non-NULL key has no
    parent row. NULL keys satisfy a foreign key and are not reported."""
    p = parent.select(F.col(parent_key).alias("__parent_k")).distinct()
    return (child.where(F.col(child_key).isNotNull())
            .join(p, F.col(child_key) == F.col("__parent_k"), "left_anti"))


def self_orphans(df: DataFrame, id_col: str, ref_cols: Sequence[str]) -> DataFrame:
    """Self-referencing foreign keys (D15): for each role column, rows pointing
    at an id the table does not hold, with the role and the dangling value."""
    refs = df.select(F.col(id_col), F.explode(F.array(*[
        F.struct(F.lit(c).alias("role"), F.col(c).alias("missing_id")) for c in ref_cols])).alias("ref"))
    return orphans(refs.select(id_col, "ref.role", "ref.missing_id"), "missing_id", df, id_col)
