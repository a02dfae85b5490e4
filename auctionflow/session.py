"""Session helpers.

The library never creates machine-local folders on a cluster: the checkpoint
folder is read from the session (``spark.checkpoint.dir``).  Only a local
session (tests, bench) gets a scratch folder when none is configured.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files go when no plan refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Broadcast only what the planner has measured to be small.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "auctionflow", extra: dict | None = None) -> SparkSession:
    """A ``local[cpus]`` session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    Uses ``spark.checkpoint.dir`` when the cluster names one.  A scratch
    folder is created only for local masters where nothing is configured.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="auctionflow-ckpt-"))
    return sc.getCheckpointDir()


def cluster_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Starting settings for a cluster run over ``input_bytes`` of Parquet.

    * ``spark.sql.files.maxPartitionBytes`` = ``partition_bytes`` (scan splits);
    * ``spark.sql.shuffle.partitions`` = enough for ~``partition_bytes`` per
      reducer if the whole input were shuffled, at least 2x the cores (AQE
      coalesces small ones at run time);
    * AQE advisory size and skew-join thresholds at the same scale, so a
      hot join key is split instead of landing in one task.
    At 100 TB with 256 MB partitions this gives ~400k shuffle partitions.
    """
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
