"""Record access re-aimed as bulk table jobs.

The source answers one token or person per call, with one query per id. Here
a *table of requests* is answered by one join, so the work is a single
shuffle (or broadcast) however many requests there are. Values are columns,
never text spliced into a statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import fixed as fx
from tessera.operators.joins import exists_flag
from tessera.sources.sinks import append_named


def token_exists(requests: DataFrame, tokens: DataFrame, token_col: str = "authToken",
                 name: str = "token_exists") -> DataFrame:
    """Per request: does any row hold exactly this token (case-sensitive)."""
    t = tokens.select(F.col(token_col).alias("__tok"))
    return exists_flag(requests, t, [(token_col, "__tok")], name)


def token_user_exists(requests: DataFrame, tokens: DataFrame, name: str = "pair_exists") -> DataFrame:
    """Per request: token *and* user both match one row."""
    t = tokens.select(F.col("authToken").alias("__tok"), F.col("userName").alias("__usr"))
    return exists_flag(requests, t, [("authToken", "__tok"), ("userName", "__usr")], name)


def lookup_value(requests: DataFrame, table: DataFrame, key: str, value: str, out: str,
                 default=None) -> DataFrame:
    """Per request: the value stored under ``key``, ``default`` when absent
    (D3, D7). The table is folded to one row a key first, inside each task, so a
    hot key's rows never meet in one. A key stored twice resolves to its greatest
    value, a deterministic stand-in for the source's "last row read wins"."""
    found = table.groupBy(key).agg(F.max(value).alias("__found"))
    res = requests.join(found, key, "left")
    val = F.col("__found") if default is None else F.coalesce(F.col("__found"), F.lit(default))
    return res.withColumn(out, val).drop("__found")


def token_user_name(requests: DataFrame, tokens: DataFrame) -> DataFrame:
    """``getUserName``: user of each requested token, ``''`` when absent (D3)."""
    return lookup_value(requests.select("request_id", "authToken"), tokens, "authToken",
                        "userName", "userName", default=fx.MISSING_USER_NAME)


def insert_if_absent(table: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``addAuthToken`` for a batch (D4): a row is rejected when the table already
    holds its ``key``, with the same values ("row exists") or others ("key
    exists", which the primary key refuses). Of rows that repeat a key inside the
    batch the smallest goes in, other ones are rejected ("key repeated").
    Returns ``(new_table, accepted_rows, rejected_rows with reason)``."""
    cols = table.columns
    rest = [c for c in cols if c != key]
    batch = exists_flag(rows.select(*cols), table, [(key, key)], "__known")
    batch = exists_flag(batch, table, [(c, c) for c in cols], "__same")
    fresh = batch.where(~F.col("__known")).select(*cols)
    counted = fresh.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
    first = fresh.groupBy(key).agg(F.min(F.struct(*rest)).alias("__first"))
    accepted = first.select(key, "__first.*").select(*cols)
    again = (counted.join(first.withColumnRenamed(key, "__k"), F.col(key) == F.col("__k"))
             .where((F.col("__n") > 1) | (F.struct(*rest) != F.col("__first")))
             .select(*cols, F.lit("key repeated").alias("reason")))
    held = batch.where("__known").select(
        *cols, F.when(F.col("__same"), "row exists").otherwise("key exists").alias("reason"))
    return append_named(table, accepted), accepted, held.unionByName(again)


def delete_by_key(table: DataFrame, keys: DataFrame, col: str, keys_col: str | None = None) -> DataFrame:
    """``DELETE FROM t WHERE col = :k`` for a set of keys (D5, D10): a left anti
    join, written out by the caller as the table's new version. Columns keep
    their order."""
    kc = keys_col or col
    return table.join(keys.select(F.col(kc).alias(col)).distinct(), col, "left_anti").select(*table.columns)


def person_record(requests: DataFrame, persons: DataFrame, id_col: str = "id") -> DataFrame:
    """``readPerson`` (D8): the record of each requested id; an unknown id
    gives a record with only the id set."""
    p = persons.withColumnRenamed(id_col, "__pid")
    res = requests.join(p, requests[id_col] == p["__pid"], "left").drop("__pid")
    return res


def persons_of_user(requests: DataFrame, persons: DataFrame, user_col: str = "userName") -> DataFrame:
    """``readPersons`` (D9): all persons whose ``descendant`` is the requested
    user, one per distinct id (the source collects ids into a set), in one
    join instead of one query per id. Persons are folded to one row per (descendant,
    id) first, a shuffle that spreads a large family over the tasks; what is left of it
    then meets the users in a join that the optimiser may broadcast or split."""
    users = requests.select(F.col(user_col).alias("__user")).distinct()
    # one row per id, the smallest of a repeated id; columns keep their order
    rest = [c for c in persons.columns if c not in ("descendant", "id")]
    one = (persons.where(F.col("descendant").isNotNull()).groupBy("descendant", "id")
           .agg(F.min(F.struct(*rest)).alias("__one")))
    return (one.join(users, F.col("descendant") == F.col("__user"), "left_semi")
            .select("descendant", "id", "__one.*").select(*persons.columns))


def append_person(table: DataFrame, rows: DataFrame, null_text: bool = False) -> DataFrame:
    """``addPerson`` for a batch (D11). The source builds the INSERT by string
    concatenation, so a missing father / mother / spouse is stored as the
    text ``'null'``; ``null_text=True`` reproduces that, the default stores a
    real NULL."""
    if null_text:
        rows = rows.select(*[F.coalesce(F.col(c), F.lit(fx.MISSING_PARENT_TEXT)).alias(c)
                             if c in ("fatherID", "motherID", "spouseID") else F.col(c)
                             for c in rows.columns])
    return append_named(table, rows.select(*table.columns))
