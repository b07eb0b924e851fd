"""Session helpers.

The engine never depends on session settings for correctness; these are the
settings we use for tests and the benchmark, sized for local mode.  On a
cluster, pass the existing session: nothing here overrides what the cluster
has configured (shuffle partitions, checkpoint folder, broadcast threshold).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "formlens",
                event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark (UI off).

    ``event_log_dir`` writes Spark's event log there, the way to read stage
    and task times without a UI.
    """
    master = master or os.environ.get("FORMLENS_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # the cleaning projection is wide: above this size the JVM does not compile a generated
        # method, so Spark's own limit is set to it (worth setting on a cluster, too)
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FORMLENS_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); we read it and never replace it, and its absence is an error.  Only
    local runs (tests) without that setting get a fresh folder under the system
    temp directory.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="formlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unique path in the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/formlens/{name}-{uuid.uuid4().hex[:12]}"
