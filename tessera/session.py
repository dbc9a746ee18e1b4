"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults tuned for the pipelines in this package. AQE re-plans joins from
# runtime sizes (broadcast when a side turns out small, skew-split hot keys)
# and coalesces the many small post-aggregation partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Coalesce to the advisory size above rather than to the default
    # parallelism (which would ignore it): fewer, fuller post-shuffle tasks,
    # as Spark recommends on shared clusters.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with the package defaults.

    On a cluster leave ``master`` unset (spark-submit provides it): the
    cluster's ``spark.sql.shuffle.partitions`` is kept unless
    ``shuffle_partitions`` is given (size it to roughly the largest shuffle /
    128 MB; AQE coalesces small partitions and splits skewed join partitions
    from there). For a local master it defaults to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif master and master.startswith("local"):
        conf["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory set earlier on
    the context). Only when neither exists and the master is local, as in tests,
    a private directory is created; on a cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client, use the conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def session_key(spark: SparkSession) -> str:
    """An identifier of the running application (classic or Connect)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))
