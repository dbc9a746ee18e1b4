"""Sinks: overwrite, append, create-from-query, views, drop.

Tables are parquet folders under ``<checkpoint dir>/tables``: the shared
folder the cluster names in ``spark.checkpoint.dir`` (see ``checkpoint_dir``),
never a machine-local temp folder. Writing and re-reading also cuts lineage,
which is how long pipelines survive lost executors without recomputing from
the raw scans.

An overwrite writes a new version folder and then swaps the table's pointer
file, so a table can be refreshed from itself and a write that dies half way
leaves the old rows. ``save_table`` publishes a query in the session's catalog
instead, bucketed if wanted. Intermediates (``materialize``) belong to the
``Stages`` scope they are written in, which removes them.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir
from tessera.sources.tables import name_parts, quoted_name

POINTER = "_current"
VERSIONS_KEPT = 2  # the current one and the one a reader may still be on
BUCKET_ROWS = 1_000_000  # rows that a task sorts, writes or joins, where keys are spread
MIN_BUCKETS, MAX_BUCKETS = 8, 100_000  # the latter is Spark's own limit


def table_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def unique_name(prefix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex[:12]}"


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def current_version(spark: SparkSession, name: str) -> str | None:
    """The folder the table's pointer names; None if there is no such table."""
    pointer, fs = _path(spark, f"{table_path(spark, name)}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        version = stream.readUTF()
    finally:
        stream.close()
    return f"{table_path(spark, name)}/{version}"


def _swap(spark: SparkSession, name: str, version: str) -> None:
    """Point the table at ``version``: the pointer is written aside and renamed over
    the old one in one step; versions before the last two are removed."""
    jvm, folder = spark.sparkContext._jvm, table_path(spark, name)
    aside, fs = _path(spark, f"{folder}/{POINTER}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(aside, True)
    stream.writeUTF(version)
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        aside.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    rename[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    pointer, _ = _path(spark, f"{folder}/{POINTER}")
    context.rename(aside, pointer, rename)
    versions = sorted((s for s in fs.listStatus(pointer.getParent()) if s.getPath().getName().startswith("v-")),
                      key=lambda s: (s.getPath().getName() == version, s.getModificationTime()))
    for old in versions[:-VERSIONS_KEPT]:
        fs.delete(old.getPath(), True)


def write_table(df: DataFrame, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` and return the re-read table.

    ``mode="overwrite"`` is DROP + CREATE (full refresh): the rows go to a new
    version folder, then the table's pointer is swapped, so ``df`` may read the
    table itself and readers see the old rows until the write has ended.
    ``"append"`` is INSERT of the rows into the current version; columns are
    matched by name, as a column-list INSERT: one that the rows lack is NULL, one
    that the table lacks is an error.
    """
    spark = df.sparkSession
    path = current_version(spark, name) if mode == "append" else None
    if path is not None:
        stored = spark.read.parquet(path)
        unknown = [c for c in df.columns if c not in stored.columns]
        if unknown:
            raise ValueError(f"table {name} has no column {', '.join(unknown)}")
        have = set(df.columns)
        df = df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in stored.schema])
    elif mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r} is neither overwrite nor append")
    version = None if path else unique_name("v")
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path or f"{table_path(spark, name)}/{version}")
    if version:
        _swap(spark, name, version)
    return read_table(spark, name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The table's current version; an unknown table is an ``AnalysisException``."""
    return spark.read.parquet(current_version(spark, name) or table_path(spark, name))


def buckets_for(rows: int) -> int:
    """Buckets of a table of ``rows`` rows: as many more as the table grows."""
    return min(max(-(-rows // BUCKET_ROWS), MIN_BUCKETS), MAX_BUCKETS)


def save_table(df: DataFrame, name: str | Sequence[str], buckets: int | None = None,
               bucket_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
    """Publish ``df`` as the catalog table ``name`` (one to three parts) and return it.

    It outlives the session where the catalog does. With ``buckets`` the rows are
    dealt by a hash of ``bucket_by`` and sorted by it, so joins and groupings on those
    columns with a table of as many buckets need no exchange. The rows are first
    dealt to their buckets' tasks: one file a bucket instead of one a task and bucket.
    """
    writer = df
    if buckets:
        writer = writer.repartition(buckets, *bucket_by)
    writer = writer.write.mode("overwrite").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(quoted_name(name))
    return df.sparkSession.table(quoted_name(name))


def create_table_as(query: DataFrame, name: str) -> DataFrame:
    """``SELECT ... INTO name`` / CTAS: materialise a query and re-read it."""
    return write_table(query, name, mode="overwrite")


def append_named(table: DataFrame, rows: DataFrame) -> DataFrame:
    """Column-list INSERT as a plan: rows are matched to the table by name,
    columns the rows lack are NULL."""
    return table.unionByName(rows, allowMissingColumns=True)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Publish a query as a named view (the model/"governed table" output)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str | Sequence[str]) -> None:
    """``DROP TABLE IF EXISTS`` for a temp view, a written table or a catalog table.

    Only a name of one part can be a view or a written table; ``a.b`` and ``a.b.c``
    (or a sequence of parts, which may hold dots) are catalog tables. Where a
    catalog or database of that name does not exist there is nothing to drop.
    """
    parts = name_parts(name)
    if len(parts) == 1:
        remove_folder(spark, table_path(spark, parts[0]))
        spark.catalog.dropTempView(parts[0])
    try:
        spark.sql(f"DROP TABLE IF EXISTS {quoted_name(parts)}")
    except AnalysisException as error:
        if error.getCondition() not in ("SCHEMA_NOT_FOUND", "CATALOG_NOT_FOUND"):
            raise


class Stages:
    """The intermediates written in a ``with`` block, removed at its end.

    ``with Stages(spark) as stages: out = stages.keep(query(...))`` runs a query,
    writes its result and leaves nothing else behind. ``release`` removes single
    stages as soon as what reads them is written. Scopes nest: the innermost owns
    a stage, and what it keeps belongs to the one around it. Files of a live stage
    stay, so a lost executor re-reads them. At the end the JVM is asked to collect, as
    Spark removes the shuffle files of plans that nothing refers to only then.
    """

    _open: list[Stages] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Stages:
        Stages._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Stages._open.remove(self)
        for path in self.paths:
            remove_folder(self.spark, path)
        collect_spent(self.spark)

    def keep(self, df: DataFrame, prefix: str = "kept", compression: str | None = None) -> DataFrame:
        """``df`` written outside this scope."""
        at = Stages._open.index(self)
        within, Stages._open[at:] = Stages._open[at:], []
        try:
            return materialize(df, prefix, compression)
        finally:
            Stages._open[at:] = within


def collect_spent(spark: SparkSession) -> None:
    """Ask the JVM to collect, so Spark removes the shuffle files of plans that nothing refers to."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release(*frames: DataFrame) -> None:
    """Remove the folders of materialised frames whose last reader is done. Plans that
    were built on them and have not run can run no more."""
    for df in frames:
        path = getattr(df, "_stage_path", None)
        if path is not None:
            remove_folder(df.sparkSession, path)
            for scope in Stages._open:
                if path in scope.paths:
                    scope.paths.remove(path)


def materialize(df: DataFrame, prefix: str = "stage", compression: str | None = None) -> DataFrame:
    """Compute ``df`` once and return it re-read from the shared folder.

    For intermediates that a pipeline reads several times (a calendar, a
    roster, monthly actuals): without it every reader re-runs the upstream
    scans and shuffles. The result has no lineage back to the sources, so a
    lost executor re-reads files instead of recomputing the plan. Writing
    parquet costs one job; ``DataFrame.checkpoint()`` would run the plan twice
    (once for its count, once to write) unless it were also persisted. The
    folder lives until the ``Stages`` scope around it ends or ``release`` is called.
    ``compression`` is the session's unless given.
    """
    spark = df.sparkSession
    path = table_path(spark, unique_name(prefix))
    if Stages._open:
        Stages._open[-1].paths.append(path)
    df.write.mode("overwrite").parquet(path, compression=compression)
    written = spark.read.parquet(path)
    written._stage_path = path
    return written
