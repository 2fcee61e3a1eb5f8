"""Session helpers: building a session for tests/bench and locating the
shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "pipewatch") -> SparkSession:
    """Session used by tests and ``bench.py``.  On a cluster the caller's
    own session is used instead and none of these settings are forced."""
    builder = (
        SparkSession.builder.master(master or "local[8]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", os.environ.get("PIPEWATCH_TZ", "UTC"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
        .config("spark.driver.memory", os.environ.get("PIPEWATCH_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _fallback_root(spark: SparkSession) -> str:
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse")
    return warehouse.rstrip("/") + "/_pipewatch_work"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and work files.

    ``spark.checkpoint.dir`` (a static setting, read from the session) wins;
    a folder already registered with the context comes next; only when
    neither exists on a local master (tests) is a folder under the warehouse
    registered with ``SparkContext.setCheckpointDir``.  A cluster without one
    is refused: its executors would not see each other's files."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _fallback_root(spark)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the shared checkpoint folder (see
    :func:`ensure_checkpoint_dir`); never a machine-local temporary folder
    unless the session itself names one."""
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), *parts, uuid.uuid4().hex])
