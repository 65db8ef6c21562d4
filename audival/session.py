"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "audival",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session tuned for the models: AQE on (coalescing, skew splits and
    runtime broadcast of sides measured below the threshold), UTC, no UI."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Broadcast only sides Spark has measured below 10 MB. File sizes are
        # compressed parquet, so they are scaled by 4 before the check; at
        # runtime AQE measures the shuffle output itself.
        "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
        "spark.sql.sources.fileCompressionFactor": "4.0",
    }
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = os.environ.get("AUDIVAL_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for materialised stages.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when the
    cluster names one. Only a local-mode session without one gets a fresh
    scratch folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no context
        sc = None
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this session")
    configured = configured or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
    path = tempfile.mkdtemp(prefix="audival-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
