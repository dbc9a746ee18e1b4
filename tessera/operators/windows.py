"""Window operators.

Every window has a partition key (there is no global, single-task window),
every order names its NULL placement and ends with a tie-break, so row
numbers are deterministic and engine-independent. Which form runs where:

* ``row_number`` - a plain window: one shuffle on the key and a sort. Used
  where the partitions are bounded (aggregated rows, a dimension) or where
  only ``rank = 1`` is read, which Spark limits per task before the shuffle
  (``latest_per_key``).
* ``row_number_split`` - full numbering over keys that may be hot: the key's
  rows are spread over several tasks and stitched with a bounded offsets
  table (see its docstring).
* ``share_of_total`` - a count's share of its group total, as a window
  over aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.sinks import materialize


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def asc(col: str) -> Column:
    return F.col(col).asc_nulls_last()


def desc(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def row_number(partition: Sequence[str | Column], order: Sequence[Column]) -> Column:
    """``ROW_NUMBER() OVER (PARTITION BY .. ORDER BY ..)`` as bigint."""
    w = Window.partitionBy(*_cols(partition)).orderBy(*order)
    return F.row_number().over(w).cast("bigint")


def first_last(df: DataFrame, partition: Sequence[str], order_col: str, tie: Sequence[str],
               first_name: str = "taken_order", last_name: str = "rev_taken_order",
               num_partitions: int | None = None) -> DataFrame:
    """Ascending and descending rank on the same partition (N3), NULLs of ``order_col``
    last in both, from one split numbering: the reverse rank follows from the rows
    after a row in its slice and in later slices, so there is one range shuffle and one
    write. ``tie`` makes the order total; the reverse order reads it backwards.
    (Where only the rank-1 rows are needed, ``min_by`` / ``max_by`` aggregates
    are cheaper; see ``usage_by_student.lessons_per_student``.)"""
    fixed, around = _slices(df, partition, [asc(order_col), *[asc(c) for c in tie]], num_partitions, order_col)
    out = _with_offsets(fixed, around, partition)
    valued = F.col("__vbefore") + F.col("__v") + F.col("__vafter")  # rows of the key with a value
    rev = F.when(F.col(order_col).isNotNull(), F.col("__v") - F.col("__lrn") + 1 + F.col("__vafter")).otherwise(
        valued + F.col("__n") - F.col("__lrn") + F.col("__after") - F.col("__vafter") + 1)
    return (out.withColumn(first_name, (F.col("__lrn") + F.col("__before")).cast("bigint"))
            .withColumn(last_name, rev.cast("bigint"))
            .drop("__pid", "__lrn", "__n", "__v", *AROUND))


def latest_per_key(df: DataFrame, key: Sequence[str], order_col: str, tie: Sequence[str] = (),
                   rank_name: str | None = None) -> DataFrame:
    """Newest row per key (N9, O5): ``ROW_NUMBER() .. ORDER BY d DESC = 1``.
    The equality filter on the rank lets Spark insert a per-task
    ``WindowGroupLimit`` before the shuffle, so a hot key ships one row per
    task instead of all of its rows."""
    order = [desc(order_col), *[desc(c) for c in tie]]
    rn = row_number(key, order)
    out = df.withColumn("__rn", rn).where(F.col("__rn") == 1)
    return out.withColumnRenamed("__rn", rank_name) if rank_name else out.drop("__rn")


def share_of_total(df: DataFrame, part_keys: Sequence[str], total_keys: Sequence[str],
                   name: str, count_name: str = "n") -> DataFrame:
    """``DISTINCT keys, 1.0 * COUNT(*) OVER (part) / COUNT(*) OVER (total)``
    (N6, N8) written as aggregate-then-window: rows are counted per
    ``part_keys`` with a partial aggregate first, and the window runs over that
    small result, so no raw row is shuffled for the window."""
    counts = df.groupBy(*part_keys).agg(F.count(F.lit(1)).alias(count_name))
    total = F.sum(count_name).over(Window.partitionBy(*total_keys))
    return counts.withColumn(name, F.col(count_name).cast("double") / total.cast("double"))


def row_number_split(df: DataFrame, partition: Sequence[str], order: Sequence[Column], name: str,
                     num_partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY partition ORDER BY order)`` that never
    holds one key's rows in a single task.

    A plain window shuffles every row of a key to one task; a key holding a
    third of the data would then be sorted by one core. Here:

    1. rows are range-partitioned on (key, order), so a hot key's rows are
       spread, in order, over consecutive partitions;
    2. each (partition, key) slice is numbered locally (the window's shuffle
       is on (partition id, key), so a hot key is split as well), and the
       result is written once to the shared folder, which fixes every row's
       partition id;
    3. a slice's offset is the number of rows of its key in earlier
       partitions. Only a partition's first and last key can lie in other
       partitions as well, so the offsets table has at most two rows a
       partition: a proven bound, and it is broadcast.

    ``order`` should end in a tie-break that makes it total, as with any
    deterministic row number.
    """
    fixed, around = _slices(df, partition, order, num_partitions)
    out = _with_offsets(fixed, around, partition)
    return (out.withColumn(name, (F.col("__lrn") + F.col("__before")).cast("bigint"))
            .drop("__pid", "__lrn", "__n", "__v", *AROUND))


AROUND = ["__before", "__vbefore", "__after", "__vafter"]


def _slices(df: DataFrame, partition: Sequence[str], order: Sequence[Column], num_partitions: int | None = None,
            value: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows range-partitioned on (key, order) and written, each with its partition
    ``__pid``, its rank ``__lrn`` in its (partition, key) slice and the slice's rows
    ``__n`` (``__v``: those with a ``value``); and, for slices whose key goes on in other
    partitions, the rows before and after. Only a partition's first and last key can
    go on, so that table has at most two rows a partition."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition)
    slice_rows = Window.partitionBy("__pid", *keys)
    counted = F.count(F.lit(1) if value is None else F.col(value))
    fixed = materialize(
        df.repartitionByRange(n, *[asc(k) for k in keys], *order).withColumn("__pid", F.spark_partition_id())
        .withColumn("__lrn", F.row_number().over(slice_rows.orderBy(*order)))
        .withColumn("__n", F.count(F.lit(1)).over(slice_rows)).withColumn("__v", counted.over(slice_rows)), "rank")
    slices = fixed.groupBy("__pid", *keys).agg(F.first("__n").alias("__n"), F.first("__v").alias("__v"))
    by_key = Window.partitionBy(*keys).orderBy("__pid")
    before = by_key.rowsBetween(Window.unboundedPreceding, -1)
    after = by_key.rowsBetween(1, Window.unboundedFollowing)
    none = F.lit(0).cast("bigint")
    around = slices.select("__pid", *keys, *[
        F.coalesce(F.sum(c).over(w), none).alias(a)
        for a, c, w in zip(AROUND, ["__n", "__v"] * 2, [before, before, after, after])])
    return fixed, around.where((F.col("__before") > 0) | (F.col("__after") > 0))


def _with_offsets(fixed: DataFrame, around: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``fixed`` with its slices' rows around, 0 for keys that lie in one partition."""
    offsets = around.select(F.col("__pid").alias("__opid"),
                            *[F.col(k).alias(f"__ok{i}") for i, k in enumerate(keys)], *AROUND)
    cond = F.col("__pid") == F.col("__opid")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__ok{i}"))
    return (fixed.join(F.broadcast(offsets), cond, "left")
            .fillna(0, AROUND).drop("__opid", *[f"__ok{i}" for i in range(len(keys))]))
