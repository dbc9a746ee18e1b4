"""Sinks: overwrite replaces, append adds by name, CTAS re-reads, views resolve."""

from __future__ import annotations

from tests.conftest import rows
from tessera.sources import sinks


def test_overwrite_then_append_by_name(spark):
    name = sinks.unique_name("t")
    a = spark.createDataFrame([("t1", "u1"), ("t2", "u2")], "authToken string, userName string")
    b = spark.createDataFrame([("t3", "u3")], "authToken string, userName string")
    sinks.write_table(a, name)
    assert rows(sinks.write_table(b, name)) == [("t3", "u3")]          # full refresh
    c = spark.createDataFrame([("u4", "t4")], "userName string, authToken string")
    got = sinks.write_table(c, name, mode="append")                   # column-list insert
    assert rows(got, "authToken", "userName") == [("t3", "u3"), ("t4", "u4")]
    assert rows(sinks.read_table(spark, name)) == rows(got)


def test_ctas_view_and_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    t = sinks.create_table_as(df, sinks.unique_name("ctas"))
    assert rows(t) == [(1, 2)]
    v = sinks.register_view(t, "tessera_test_view")
    assert rows(spark.table("tessera_test_view")) == rows(v)
    sinks.drop_table(spark, "tessera_test_view")
    assert not spark.catalog.tableExists("tessera_test_view")


def test_materialize_cuts_lineage_and_lives_in_the_checkpoint_folder(spark):
    from tessera.session import checkpoint_dir
    df = spark.range(10).selectExpr("id * 2 AS x")
    m = sinks.materialize(df)
    assert rows(m) == rows(df)
    from urllib.parse import urlparse
    folder = urlparse(checkpoint_dir(spark)).path.rstrip("/")
    assert urlparse(m.inputFiles()[0]).path.startswith(folder + "/tables/")


def test_table_handles_are_cached_and_refreshable(spark):
    from tessera.sources.tables import Tables
    from tests.conftest import SF_SMALL
    a, b = Tables(spark, SF_SMALL).region, Tables(spark, SF_SMALL).region
    assert a is b
    Tables.refresh(SF_SMALL)
    assert Tables(spark, SF_SMALL).region is not a


def test_append_checks_columns_and_drop_removes_the_table(spark):
    import pytest
    from pyspark.errors import AnalysisException

    name = sinks.unique_name("t")
    schema = "authToken string, userName string"
    sinks.write_table(spark.createDataFrame([("t1", "u1")], schema), name)
    got = sinks.write_table(spark.createDataFrame([("t2",)], "authToken string"), name, mode="append")
    assert got.columns == ["authToken", "userName"]
    assert rows(got) == [("t1", "u1"), ("t2", None)]
    with pytest.raises(ValueError):
        sinks.write_table(spark.createDataFrame([("t3", "x")], "authToken string, other string"), name, mode="append")
    sinks.drop_table(spark, name)
    with pytest.raises(AnalysisException):
        sinks.read_table(spark, name)
