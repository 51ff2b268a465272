"""Session settings the jobs are designed for.

On a cluster the session comes from the platform; ``CLUSTER_CONF`` lists the
settings the jobs assume (AQE with skew-join splitting, UTC). ``local_session``
builds a local session for tests and benchmarks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the jobs are written against.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when the aggregation after the join
    # then needs its own exchange (otherwise AQE keeps the hot task whole)
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # partitions sized for memory: scan splits and post-shuffle partitions
    # of ~256 MB; AQE coalesces the shuffle partitions down from the
    # session's spark.sql.shuffle.partitions (set it to a few thousand on a
    # large cluster) and splits skewed ones
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tillroll") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TILLROLL_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared ``spark.checkpoint.dir``. A scratch folder is set
    only for a local-mode session that has none (tests); on a cluster the
    setting must come from the platform, since a machine-local folder would
    not survive the loss of the executor that wrote it."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's own setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running jobs that checkpoint")
    scratch = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch
