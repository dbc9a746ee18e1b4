"""Scans of named tables: parquet paths and catalog names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.session import session_key

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table. Naming ``columns`` prunes the scan up front; without
    them Catalyst still prunes to whatever the plan finally uses."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def name_parts(name: str | Sequence[str]) -> list[str]:
    """The one to three parts of a table name: ``a.b.c``, a part that holds a dot in
    backquotes (``a.`b.c```, a backquote in it doubled), or a sequence of parts as they are."""
    if not isinstance(name, str):
        parts = list(name)
    else:
        found = re.fullmatch(r"(?:`(?:[^`]|``)+`|[^.`]+)(?:\.(?:`(?:[^`]|``)+`|[^.`]+))*", name)
        if not found:
            raise ValueError(f"not a table name: {name!r}")
        parts = [p[1:-1].replace("``", "`") if p.startswith("`") else p
                 for p in re.findall(r"`(?:[^`]|``)+`|[^.`]+", name)]
    if not 1 <= len(parts) <= 3 or not all(parts):
        raise ValueError(f"a table name has one to three parts: {name!r}")
    return parts


def quoted_name(name: str | Sequence[str]) -> str:
    """The name with every part in backquotes, as SQL and the catalog read it."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name_parts(name))


def load_table(spark: SparkSession, name: str | Sequence[str], *columns: str) -> DataFrame:
    """``FROM db.table`` or ``FROM catalog.db.table``: a table of the session's catalogs."""
    df = spark.table(quoted_name(name))
    return df.select(*columns) if columns else df


def attach(spark: SparkSession, sf_dir: str, name: str, database: str) -> list[str]:
    """Make a parquet table of ``sf_dir`` known to the catalog as ``database.name``, as an
    external table (its files stay where they are); returns the name's parts."""
    parts = [database, name]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted_name([database])}")
    if not spark.catalog.tableExists(quoted_name(parts)):
        spark.catalog.createTable(quoted_name(parts), path=f"{sf_dir.rstrip('/')}/{name}.parquet", source="parquet")
    return parts


class CatalogTables:
    """Attribute access to the tables of a database: ``CatalogTables(spark, "lake.shop").lineitem``."""

    def __init__(self, spark: SparkSession, database: str | Sequence[str]):
        self.spark, self.database = spark, name_parts(database)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load_table(self.spark, [*self.database, name])


class Tables:
    """Attribute access to the tables of one data directory: ``t.lineitem``.

    Table handles are kept per application and directory, so a session that
    runs many reports resolves each table's file listing and parquet schema
    once instead of once per report. Only the handle is kept, never data.
    """

    _handles: dict[tuple[str, str, str], DataFrame] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def refresh(cls, sf_dir: str | None = None) -> None:
        """Forget cached handles (all, or those of one directory), e.g. after
        the files under a directory were replaced."""
        for key in list(cls._handles):
            if sf_dir is None or key[1] == sf_dir.rstrip("/"):
                del cls._handles[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        key = (session_key(self.spark), self.sf_dir.rstrip("/"), name)
        df = Tables._handles.get(key)
        if df is None or df.sparkSession is not self.spark:
            df = Tables._handles[key] = load(self.spark, self.sf_dir, name)
        return df
