"""SparkSession helpers.

The library itself never creates a session; these helpers are for tests,
the benchmark and the command line.  Cluster settings (executor memory,
checkpoint directory, shuffle partitions) come from the cluster's own
configuration and are only filled in here when they are missing.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run relies on: runtime re-planning (AQE) with skew-join
# splitting and partition coalescing, UTC session time, no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Dynamic overwrite: replace only the partitions a write touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Remove checkpoint files of frames that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Profile for a large cluster (~100 TB of logs and order lines, ~1000
# executors).  The shuffle partition count is an upper bound that AQE
# coalesces to ~256 MB partitions; scans read up to 512 MB per task (about
# 200k scan tasks for 100 TB); a partition 3x the median and over 256 MB
# counts as skewed and is split; broadcasts decided by Spark stay under
# 64 MB (explicit ones go through ``functions.joins.checked_broadcast``).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rivalry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset locally.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder and is used as is; if it is missing there, this raises instead of
    falling back to a machine-local folder.  Only ``local[...]`` sessions
    without the setting (tests) get a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: set it to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="rivalry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def checkpoint_folder(spark: SparkSession) -> str | None:
    """``ensure_checkpoint_dir``, or None for a cluster session that names no folder; runs no job."""
    sc = spark.sparkContext
    if not (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.master.startswith("local")):
        return None
    return ensure_checkpoint_dir(spark)
