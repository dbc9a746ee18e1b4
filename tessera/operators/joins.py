"""Joins (J1-J16).

Physical strategy is left to Catalyst and AQE: with adaptive execution on, a
side whose *measured* shuffle output is under the broadcast threshold is
re-planned as a broadcast hash join, everything else stays sort-merge, and
skewed partitions of a hot key are split. An explicit ``broadcast`` is used
only for sides whose size is bounded by construction (a one-year calendar, a
table with at most two rows a partition).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def join_ci(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
            how: str = "inner") -> DataFrame:
    """Join on ``LOWER(left_key) = LOWER(right_key)`` (J4). The lowered keys
    are materialised as columns once, so the join is a plain equi-join that
    hashes / sorts on them."""
    lk, rk = f"__ci_{left_key}", f"__ci_{right_key}_r"
    l2 = left.withColumn(lk, F.lower(F.col(left_key)))
    r2 = right.withColumn(rk, F.lower(F.col(right_key)))
    return l2.join(r2, l2[lk] == r2[rk], how).drop(lk, rk)


def distinct_keys(other: DataFrame, key: str, alias: str) -> DataFrame:
    """The distinct values of ``other.key``. A semi or anti join only asks
    whether a key occurs, so duplicates can go before the shuffle: partial
    aggregation folds a hot key to one row per task, and the aggregate's hash
    partitioning on the key is reused by the join (no extra exchange)."""
    return other.select(F.col(key).alias(alias)).distinct()


def semi(df: DataFrame, other: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``WHERE key IN (SELECT key FROM other)`` (J13): a left-semi join against
    the subquery's distinct keys, so duplicates on the right never multiply
    the left or pile up in one task."""
    o = distinct_keys(other, right_key or left_key, "__semi_k")
    return df.join(o, df[left_key] == o["__semi_k"], "left_semi")


def nested_in(levels: Sequence[tuple[DataFrame, str, str | None]]) -> tuple[DataFrame, str]:
    """Resolve nested ``IN`` subqueries (J14) innermost first.

    ``levels`` lists ``(table, selected_col, tested_col)`` from the outermost
    subquery inwards; the innermost has ``tested_col=None``. Returns the
    outermost subquery as a DataFrame and its selected column. Each level is
    one left-semi join.
    """
    table, out_col, _ = levels[-1]
    for lvl_table, lvl_out, lvl_test in reversed(levels[:-1]):
        table, out_col = semi(lvl_table, table, lvl_test, out_col), lvl_out
    return table, out_col


def semi_chain(df: DataFrame, key: str, levels: Sequence[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """``WHERE key IN (SELECT .. WHERE .. IN (SELECT ..))`` as a chain of
    left-semi joins."""
    sub, col = nested_in(levels)
    return semi(df, sub, key, col)


def anti(df: DataFrame, other: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``NOT EXISTS`` (left anti join): NULL keys on either side never match,
    so left rows with a NULL key are kept."""
    o = distinct_keys(other, right_key or left_key, "__anti_k")
    return df.join(o, df[left_key] == o["__anti_k"], "left_anti")


def anti_null_aware(df: DataFrame, other: DataFrame, left_key: str,
                    right_key: str | None = None) -> DataFrame:
    """``WHERE key NOT IN (SELECT key FROM other)`` with SQL's three-valued
    logic (J15):

    * subquery empty: every row is kept, NULL keys included;
    * subquery holds a NULL: no row is kept;
    * otherwise: rows whose key is not NULL and not in the subquery.

    Spark plans ``NOT IN`` as a null-aware anti join only when it can
    broadcast the subquery, and as a nested-loop join otherwise. Here the case is
    picked inside the plan: two uncorrelated scalar subqueries (has the
    subquery any row, has it a NULL) guard the rows, and a shuffled ``left_anti``
    on the distinct keys does the rest. Nothing runs while the plan is built.
    """
    keys = distinct_keys(other, right_key or left_key, "__anti_k")
    empty = keys.agg((F.count(F.lit(1)) == 0).alias("e")).scalar()
    holds_null = keys.agg((F.count(F.lit(1)) > F.count("__anti_k")).alias("h")).scalar()
    probe = df.where(empty | (~holds_null & F.col(left_key).isNotNull()))
    return probe.join(keys, F.col(left_key) == F.col("__anti_k"), "left_anti")


BLOOM_BITS = 1 << 23  # 1 MB: 1 % of other keys pass at 700,000 keys, 5 % at 1.5 million


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in range(4)]


def _bit(slot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (slot % 64).cast("int"))


def may_hold(keys: DataFrame, key: str, tested: str, bits: int = BLOOM_BITS) -> Column:
    """A condition that is true for every row whose ``tested`` column is a ``keys.key``
    and, at the stated rate, for few others: a Bloom filter for the scan of a large table.

    The filter is one value of ``bits / 8`` bytes, an uncorrelated scalar subquery made
    of built-in functions: set bits are ORed per 64-bit word with partial aggregates, so
    neither driver nor task holds the keys. With more than half of its bits set it
    would let most rows through, so it is not used then (every row passes). An exact
    semi or inner join has to follow; the filter only keeps rows out of its shuffle.
    """
    slots = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_slots(F.col(key), bits))).alias("s"))
    words = slots.groupBy(F.floor(F.col("s") / 64).alias("w")).agg(F.bit_or(_bit(F.col("s"))).alias("m"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").alias("i"))
    dense = every.join(words, F.col("i") == F.col("w"), "left").select("i", F.coalesce("m", F.lit(0)).alias("m"))
    field = dense.agg(
        F.sum(F.bit_count("m")).alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("f"))
    field = field.select(F.when(F.col("n") * 2 <= bits, F.col("f")).alias("f")).scalar()
    held = None
    for slot in _slots(F.col(tested), bits):
        # from bit 0 to the slot's word, then the slot's bit
        hit = F.get(field, F.floor(slot / 64).cast("int")).bitwiseAND(_bit(slot)) != 0
        held = hit if held is None else held & hit
    return F.coalesce(held, F.col(tested).isNotNull())


def semi_filtered(df: DataFrame, other: DataFrame, left_key: str, right_key: str | None = None,
                  bits: int = BLOOM_BITS) -> DataFrame:
    """``semi`` with a Bloom filter on the scan of ``df`` first. ``other`` is read twice:
    pass it written or cheap."""
    return semi(df.where(may_hold(other, right_key or left_key, left_key, bits)), other, left_key, right_key)


def join_salted(left: DataFrame, right: DataFrame, left_key: str, right_key: str, how: str = "inner",
                rows_per_salt: int = 500_000) -> DataFrame:
    """Equi-join whose hot keys of ``left`` are dealt over several tasks (``how`` is inner
    or left).

    Keys with more than ``rows_per_salt`` rows are counted (folded in the map tasks); there
    are fewer of them than rows divided by that number. Their rows get a
    salt by a hash of all columns and a random part, as many salts as they have that many
    rows, and the matching rows of ``right`` are repeated once per salt. All other keys
    have salt 0. ``left`` is read twice: pass it written or cheap. NULL keys match nothing and
    are dealt over all tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner or left")
    hot = (left.where(F.col(left_key).isNotNull()).groupBy(F.col(left_key).alias("__hk"))
           .agg(F.ceil(F.count(F.lit(1)) / rows_per_salt).alias("__salts")).where("__salts > 1"))
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    dealt = (left.join(hot, F.col(left_key) == F.col("__hk"), "left")
             .withColumn("__salt", F.when(F.col(left_key).isNull(), F.xxhash64(F.monotonically_increasing_id()))
                         .otherwise(F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts)))
             .drop("__hk", "__salts"))
    copies = (right.withColumnRenamed(right_key, "__rk").join(hot, F.col("__rk") == F.col("__hk"), "left")
              .withColumn("__rsalt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
              .drop("__hk", "__salts"))
    joined = dealt.join(copies, (F.col(left_key) == F.col("__rk")) & (F.col("__salt") == F.col("__rsalt")), how)
    return joined.drop("__salt", "__rsalt").withColumnRenamed("__rk", right_key) \
        if right_key != left_key else joined.drop("__salt", "__rsalt", "__rk")


def left_join_filtered(left: DataFrame, right: DataFrame, on: Column | list,
                       right_filter: Column) -> DataFrame:
    """``LEFT JOIN r ON <keys> AND <condition on r>`` (J8): the condition is
    applied to the right side first, so unmatched left rows stay."""
    return left.join(right.where(right_filter), on, "left")


def with_names(fact: DataFrame, lookups: Sequence[tuple[DataFrame, str, str, dict[str, str]]]) -> DataFrame:
    """Star of LEFT lookups (J7): each ``(dim, fact_key, dim_key, {dim_col:
    alias})`` adds named columns; missing ids give NULL names."""
    out = fact
    for i, (dim, fact_key, dim_key, cols) in enumerate(lookups):
        k = f"__dim{i}_k"
        d = dim.select(F.col(dim_key).alias(k), *[F.col(c).alias(a) for c, a in cols.items()])
        out = out.join(d, out[fact_key] == d[k], "left").drop(k)
    return out


def exists_flag(df: DataFrame, other: DataFrame, pairs: Sequence[tuple[str, str]],
                name: str) -> DataFrame:
    """Add boolean ``name``: does ``other`` hold a row matching on all
    ``(df_col, other_col)`` pairs (``EXISTS`` with equality, so NULL keys never
    match). ``other`` is reduced to its distinct key tuples first (partial
    aggregation folds a hot key inside each task), so every ``df`` row meets
    at most one match and is never multiplied.

    A correlated ``DataFrame.exists()`` subquery would express the same, but
    when both sides derive from one scan Spark can bind the outer column to
    the inner plan; the join form has no such ambiguity."""
    keys = (other.select(*[F.col(rc).alias(f"__ex{i}") for i, (_, rc) in enumerate(pairs)])
            .distinct().withColumn("__ex_hit", F.lit(True)))
    cond = None
    for i, (lc, _) in enumerate(pairs):
        c = F.col(lc) == F.col(f"__ex{i}")
        cond = c if cond is None else cond & c
    out = df.join(keys, cond, "left")
    return (out.withColumn(name, F.coalesce(F.col("__ex_hit"), F.lit(False)))
            .drop("__ex_hit", *[f"__ex{i}" for i in range(len(pairs))]))


def expand_dates(keys: DataFrame, start: dt.date, end: dt.date, date_col: str = "date") -> DataFrame:
    """Every row of ``keys`` once per day in ``[start, end]``: the calendar x
    key product written as a per-row sequence, so it is generated inside the
    key's own partition and its size is the size of the answer (at most 366
    rows per key for a year)."""
    if end < start:
        return keys.withColumn(date_col, F.lit(None).cast("date")).where(F.lit(False))
    return keys.withColumn(date_col, F.explode(F.sequence(F.lit(start), F.lit(end))))
