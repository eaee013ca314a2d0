"""Session helpers: time zone, scratch space under the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on.

    Timestamps in the feeds are zone-free wall clock (UTC); the session zone is
    pinned so any timestamp/zone conversion is deterministic.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and scratch tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a session with a local
    master may leave it unset; it gets a private temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: only the configuration is visible
        sc = None
    if sc is not None:
        root = sc.getCheckpointDir() or root
    if not root:
        if spark.conf.get("spark.master", "").partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all "
                             "executors share")
        root = tempfile.mkdtemp(prefix="followrec-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    elif sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    return f"{checkpoint_root(spark)}/followrec-scratch/{name}-{uuid.uuid4().hex}"


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 128 * 1024 * 1024) -> dict:
    """Suggested settings for a run over `input_bytes` of feeds and messages.

    Shuffles carry pruned, filtered and partially aggregated rows, taken here
    as an eighth of the input; shuffle partitions start so each holds about
    the target size (AQE coalesces them at run time), at least twice the
    cores and at most 50,000 (beyond that the map x reduce block count, not
    the partition size, dominates). Scans are split at the target size;
    skewed partitions (5x the median and above 256 MiB) are split by AQE.
    These are for building the cluster session; the library never overrides
    them.
    """
    cores = executor_cores * executors
    shuffle_bytes = input_bytes // 8
    parts = min(50_000, max(2 * cores, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "followrec") -> SparkSession:
    """Session used by bench and tests (a cluster brings its own)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    checkpoint_root(spark)
    return spark
