"""Session construction and the shared work folder.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` (an HDFS /
object-store path every executor can reach). Only when that setting is absent,
as in local tests, a private folder is created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "tripmart", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests, bench and local runs; cluster jobs pass their own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Partitioned writes: a task writes few partition folders (one month),
        # so keep concurrent writers instead of sorting every task's rows. Each
        # open writer buffers up to a row group, hence a small cap (Spark falls
        # back to sorting when a task meets more folders).
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
        .config("spark.driver.memory", "8g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(executor_cores: int = 8, executors: int = 1000) -> dict[str, str]:
    """Settings for a large cluster (pass to the session builder).

    Shuffles start with enough partitions for the largest stage (about 3
    tasks per core) and AQE coalesces them to ~128 MB each at runtime, so
    small stages do not run thousands of empty tasks and big ones do not
    spill; hot partitions of joins and rebalances are split; raw scans use
    256 MB splits. Nothing here changes results.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions": "true",
        "spark.sql.shuffle.partitions": str(max(200, 3 * executor_cores * executors)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.maxConcurrentOutputFileWriters": "4",  # each open writer buffers up to a row group
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.task.maxFailures": "8",
        "spark.ui.enabled": "false",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for intermediate tables (``spark.checkpoint.dir``).

    Reads the setting from the session; sets a private one only where it is unset.
    """
    value = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not value:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            value = current
        elif not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_KEY} is not set: a cluster needs a folder that all executors share")
        else:
            value = tempfile.mkdtemp(prefix="tripmart-ckpt-")
            spark.sparkContext.setCheckpointDir(value)
        spark.conf.set(CHECKPOINT_KEY, value)
    return value.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder (never a machine-local temp dir)."""
    return f"{shared_dir(spark)}/tripmart/{label}-{uuid.uuid4().hex[:12]}"
