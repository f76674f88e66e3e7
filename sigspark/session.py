"""Session helpers: a local session for tests/bench and the shared scratch root."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

from sigspark.errors import ValidationError

# Settings that matter for the plans in this package. On a cluster these come
# from the job's own configuration; locally we set the same ones.
_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Checkpoint files of the distributed row index are removed once the
    # DataFrames that use them are garbage-collected (set the same on a cluster).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g",
                  app_name: str = "sigspark") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for key, value in _LOCAL_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there). When nothing is configured, a local session (one JVM) gets a
    private temporary folder; any other master is an error, since executors
    would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValidationError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="sigspark-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
        path = spark.sparkContext.getCheckpointDir() or path
    return path.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the folder."""
    root = scratch_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root


_MB = 1 << 20


def sizing(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.2,
           target_partition_mb: int = 256) -> dict[str, str]:
    """Runtime SQL settings for a large run, sized from the input.

    * shuffle partitions: enough for ``target_partition_mb`` per partition of
      the expected shuffle volume (``shuffle_fraction`` of the input — the Z
      filter and map-side aggregation shrink most plans well below the
      scan), at least two waves of the cluster's cores; AQE then coalesces
      small partitions and splits skewed ones;
    * scan splits at the same target size so a task's input fits in memory;
    * broadcast only below 64 MB, by measured size (static and AQE);
    * skew-join splitting for partitions 5× the median and above the target.
    """
    target = target_partition_mb * _MB
    shuffle_parts = max(2 * total_cores, -(-int(input_bytes * shuffle_fraction) // target))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.shuffle.partitions": str(min(shuffle_parts, 200_000)),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * _MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * _MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target),
        "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    }


def configure(spark: SparkSession, input_bytes: int, total_cores: int | None = None, **kw) -> dict[str, str]:
    """Apply ``sizing`` to a running session (all keys are runtime SQL settings)."""
    cores = total_cores or spark.sparkContext.defaultParallelism
    conf = sizing(input_bytes, cores, **kw)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf
