from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]")
             .appName("tessera-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield spark
    spark.stop()


def rows(df, *cols):
    """Rows of ``df`` as plain tuples (all columns, or ``cols``), sorted."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, x) for x in t))
