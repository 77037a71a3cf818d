"""Session helpers: one place that decides Spark settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that every job of the library relies on.  They are applied only where the
# session leaves them unset, so a cluster's own configuration always wins.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "keyfig") -> SparkSession:
    """The running session as it is, or a new one with the library's settings.

    A session that already exists (``spark-submit``, notebook) keeps every setting it has, its
    number of shuffle partitions included; only what it leaves unset gets a default.
    """
    running = SparkSession.getActiveSession()
    if running is not None:
        return ensure_settings(running)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("KEYFIG_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_settings(spark)
    return spark


def ensure_settings(spark: SparkSession) -> SparkSession:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    # Every comparison in the library assumes UTC wall-clock times.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for materialised tables and cut lineage.

    Read from ``spark.checkpoint.dir`` or, where that is unset, from the folder registered with
    ``setCheckpointDir``.  A private folder is made only in local mode, where driver and
    executors are one process; elsewhere a missing folder is an error, because each executor
    would write to its own disk.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = context.getCheckpointDir() or _FALLBACK.get(context.applicationId)
    if not path:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="keyfig-ckpt-")
        _FALLBACK[context.applicationId] = path
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared folder (one per run; never reused)."""
    return "/".join([shared_dir(spark), "keyfig", *parts, uuid.uuid4().hex])
