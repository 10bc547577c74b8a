"""SparkSession construction with the settings the operators assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs: AQE for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast conversion from measured sizes),
# UTC so dates never shift, and no UI server.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    # PySpark otherwise records the Python call site of every Column
    # operation for error context: several JVM round trips per expression,
    # which dominates planning of the wide quality aggregates.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Sizing for a large cluster (100 TB inputs, ~1000 executors), applied by
# ``get_session(profile="cluster")`` only where spark-submit / defaults did
# not set a value. Many initial shuffle partitions are safe because AQE
# coalesces them to the advisory size; 256 MB splits and post-shuffle
# partitions keep tasks in memory; a partition over 512 MB and 5x the median
# is split by the skew-join rule.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(
    master: str | None = None,
    app_name: str = "riskforge",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
    profile: str = "local",
) -> SparkSession:
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
    if profile == "cluster":
        submitted = spark.sparkContext.getConf()
        for k, v in CLUSTER_DEFAULTS.items():
            if not submitted.contains(k) and k not in (extra or {}):
                spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Where it is unset, a scratch folder is made for a local master
    (tests); any other master is an error, because executors would write to
    disks of their own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="riskforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def warehouse_path(spark: SparkSession, name: str = "warehouse") -> str:
    """A folder for materialized tables under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
