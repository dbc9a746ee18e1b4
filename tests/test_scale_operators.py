"""Bloom-filtered semi joins, salted joins, lazy NOT IN, one-pass ranks, catalog tables,
versioned tables and the life of written stages."""

from __future__ import annotations

import os
from statistics import median
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators.joins import BLOOM_BITS, anti_null_aware, join_salted, may_hold, semi, semi_filtered
from tessera.operators.windows import asc, desc, first_last
from tessera.session import checkpoint_dir
from tessera.sources import sinks
from tessera.sources.tables import CatalogTables, attach, load_table, name_parts, quoted_name
from tests.conftest import SF_SMALL, rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folder(spark) -> str:
    return urlparse(checkpoint_dir(spark)).path.rstrip("/") + "/tables"


# ------------------------------------------------------------ Bloom filter
def test_bloom_filter_keeps_every_key_and_few_others(spark):
    keys = spark.range(0, 40_000).select((F.col("id") * 7).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    facts = spark.range(0, 280_000).select(F.col("id").alias("f"))
    passed = facts.where(may_hold(keys, "k", "f", bits=1 << 19))
    assert passed.where("f % 7 = 0").count() == 40_000
    assert passed.where("f % 7 <> 0").count() < 0.03 * 240_000
    assert rows(semi_filtered(facts, keys, "f", "k", bits=1 << 19)) == rows(semi(facts, keys, "f", "k"))


def test_bloom_filter_edge_tables(spark):
    facts = spark.createDataFrame([("a",), ("b",), (None,)], "f string")
    none = spark.createDataFrame([], "k string")
    assert facts.where(may_hold(none, "k", "f", 1 << 10)).count() == 0
    full = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    # an overfull filter is not used: every row with a key passes
    assert rows(facts.where(may_hold(full, "k", "f", 1 << 10))) == [("a",), ("b",)]
    assert BLOOM_BITS // 8 <= 1 << 20


# ------------------------------------------------------------ salted join
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_deals_a_hot_key(spark, how):
    """A third of all rows on one key: same rows as the plain join, no task far above the median."""
    left = spark.range(0, 60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(5)).when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise(F.col("id") % 3000).cast("int").alias("k"), F.col("id").alias("v"))
    right = spark.createDataFrame([(i, f"n{i}") for i in range(0, 3000, 2)] + [(5, "five"), (5, "again"), (None, "x")],
                                  "id int, name string")
    plain = left.join(right, left.k == right.id, how).select("k", "v", "name")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {c: spark.conf.get(c) for c in conf}
    try:
        for c, v in conf.items():
            spark.conf.set(c, v)
        got = join_salted(left, right, "k", "id", how, rows_per_salt=500)
        tasks = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(
            F.countDistinct("v").alias("n")).collect()]
        assert max(tasks) <= 2 * median(tasks)
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert rows(got.select("k", "v", "name")) == rows(plain)


# ------------------------------------------------------------ NOT IN
@pytest.mark.parametrize("keys,want", [([], [(1,), (2,), (None,)]), ([1, 1, 9], [(2,)]), ([1, None], [])])
def test_not_in_is_one_lazy_plan(spark, keys, want):
    df = spark.createDataFrame([(1,), (2,), (None,)], "a int")
    other = spark.createDataFrame([(k,) for k in keys], "b int")
    seen = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = anti_null_aware(df, other, "a", "b")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == seen
    assert rows(plan) == sorted(want, key=lambda t: (t[0] is None, t[0]))
    assert "NestedLoop" not in plan_of(plan)


# ------------------------------------------------------------ both ranks
def test_both_ranks_from_one_split(spark):
    df = (spark.range(0, 9000)
          .withColumn("k", F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 97 == 1, F.lit(None))
                      .otherwise(F.col("id") % 40))
          .withColumn("v", F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") * 7919) % 300)))
    w = Window.partitionBy("k")
    want = (df.withColumn("f", F.row_number().over(w.orderBy(asc("v"), asc("id"))))
            .withColumn("l", F.row_number().over(w.orderBy(desc("v"), desc("id")))))
    got = first_last(df, ["k"], "v", ["id"], "f", "l", num_partitions=8)
    assert rows(got.select("id", "f", "l")) == rows(want.select("id", "f", "l"))
    assert first_last(df.limit(0), ["k"], "v", ["id"]).count() == 0


def test_both_ranks_cost_one_range_shuffle(spark):
    scope = sinks.Stages(spark)
    with scope:
        first_last(spark.range(100).withColumn("k", F.lit(1)), ["k"], "id", [])
        assert len(scope.paths) == 1


# ------------------------------------------------------------ catalog
def test_names_of_one_to_three_parts():
    assert name_parts("t") == ["t"] and name_parts("a.b.c") == ["a", "b", "c"]
    assert name_parts("a.`b.c``d`") == ["a", "b.c`d"] and quoted_name(["a.b", "c"]) == "`a.b`.`c`"
    for bad in ("a.b.c.d", "a..b", "", "a.`b"):
        with pytest.raises(ValueError):
            name_parts(bad)


@pytest.fixture
def database(spark):
    name = sinks.unique_name("db").replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder(spark)}/{name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_catalog_tables_by_two_and_three_parts(spark, database):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    sinks.save_table(df, f"{database}.people")
    assert rows(load_table(spark, f"{database}.people")) == rows(df)
    assert rows(load_table(spark, f"spark_catalog.{database}.people", "name")) == [("a",), ("b",)]
    assert rows(CatalogTables(spark, f"spark_catalog.{database}").people) == rows(df)
    sinks.drop_table(spark, f"spark_catalog.{database}.people")
    assert not spark.catalog.tableExists(f"{database}.people")
    sinks.drop_table(spark, f"{database}.people")  # nothing to drop
    sinks.drop_table(spark, "no_such_db.people")
    with pytest.raises(AnalysisException):
        load_table(spark, f"{database}.people")


def test_attached_table_is_the_parquet_table(spark, database):
    parts = attach(spark, SF_SMALL, "nation", database)
    assert attach(spark, SF_SMALL, "nation", database) == parts
    assert rows(load_table(spark, parts)) == rows(spark.read.parquet(f"{SF_SMALL}/nation.parquet"))
    sinks.drop_table(spark, parts)
    assert spark.read.parquet(f"{SF_SMALL}/nation.parquet").count() == 25


def test_bucketed_facts_join_without_an_exchange(spark, database):
    scores = spark.range(5000).select((F.col("id") % 700).alias("doc"), F.col("id").alias("s"))
    lessons = spark.range(700).select(F.col("id").alias("doc"), (F.col("id") * 2).alias("l"))
    a = sinks.save_table(scores, [database, "scores"], 4, ["doc"])
    b = sinks.save_table(lessons, [database, "lessons"], 4, ["doc"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = a.join(b, "doc").groupBy("doc").agg(F.sum("s").alias("s"), F.max("l").alias("l"))
        plan = plan_of(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert rows(joined) == rows(scores.join(lessons, "doc").groupBy("doc").agg(F.sum("s"), F.max("l")))


# ------------------------------------------------------------ versions
def test_a_table_is_refreshed_from_itself(spark):
    name = sinks.unique_name("t")
    sinks.write_table(spark.range(10), name)
    for left in (9, 8, 7, 6):
        got = sinks.write_table(sinks.read_table(spark, name).where(F.col("id") < left), name)
        assert got.count() == left
    versions = [d for d in os.listdir(f"{folder(spark)}/{name}") if d.startswith("v-")]
    assert len(versions) == 2


def test_a_write_that_dies_leaves_the_old_rows(spark):
    name = sinks.unique_name("t")
    sinks.write_table(spark.range(3), name)
    with pytest.raises(Exception):
        sinks.write_table(spark.range(10).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), name)
    assert rows(sinks.read_table(spark, name)) == [(0,), (1,), (2,)]


# ------------------------------------------------------------ stages
def test_a_scope_leaves_only_what_it_keeps(spark):
    before = set(os.listdir(folder(spark))) if os.path.isdir(folder(spark)) else set()
    with sinks.Stages(spark) as outer:
        a = sinks.materialize(spark.range(5), "a")
        with sinks.Stages(spark) as inner:
            b = sinks.materialize(a.where("id > 1"), "b")
            kept = inner.keep(b.where("id > 2"), "c")
        assert rows(kept) == [(3,), (4,)]
        sinks.release(a)
        sinks.release(a, spark.range(3))
        out = outer.keep(kept, "out")
    left = set(os.listdir(folder(spark))) - before
    assert len(left) == 1 and left.pop().startswith("out") and rows(out) == [(3,), (4,)]


def test_a_scope_cleans_up_after_an_error(spark):
    with pytest.raises(ZeroDivisionError):
        with sinks.Stages(spark) as stages:
            sinks.materialize(spark.range(5))
            path = urlparse(stages.paths[0]).path
            assert os.path.isdir(path)
            1 / 0
    assert not os.path.isdir(path) and not sinks.Stages._open


def test_buckets_follow_the_rows(monkeypatch):
    """A task's share stays bounded however many rows there are."""
    assert sinks.buckets_for(0) == sinks.buckets_for(600_000) == sinks.MIN_BUCKETS
    assert sinks.buckets_for(216_000_000) == 216 and sinks.buckets_for(10 ** 15) == sinks.MAX_BUCKETS


def test_the_bucketed_join_deals_more_lines_over_more_buckets(spark, monkeypatch):
    from tessera.plans.catalog import QUERIES

    monkeypatch.setattr(sinks, "BUCKET_ROWS", 300)
    got = QUERIES["join_bucketed"](spark, SF_SMALL)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    buckets = -(-lines.count() // 300)
    assert buckets > sinks.MIN_BUCKETS and plan_of(got).count("Bucketed: true") == 2
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in plan_of(got) and "Exchange hash" not in plan_of(got)
    assert got.agg(F.sum("n_lines")).first()[0] == lines.count()
