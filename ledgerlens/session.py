"""Session construction and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings the operators are written for.  AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is small, sort-merge beyond),
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


MAX_SHUFFLE_PARTITIONS = 32_768


def scale_conf(input_bytes: int, task_slots: int, partition_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of fact data.

    * scans: ``maxPartitionBytes`` = ``partition_bytes`` (one split per ~256 MiB);
    * shuffles: start with ~``partition_bytes`` per partition of a shuffle as
      large as the input, at least 2 waves of the cluster's task slots and at
      most ``MAX_SHUFFLE_PARTITIONS``: the driver keeps a size per map task and
      partition, and most shuffles carry folded rows.  AQE coalesces small
      partitions to the advisory size and splits skewed ones (5x median and
      > 1 GiB); a shuffle of the raw input at 100 TB spills within its tasks;
    * broadcast joins only below 64 MiB measured at runtime.
    """
    partitions = max(2 * task_slots, min(MAX_SHUFFLE_PARTITIONS, -(-input_bytes // partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ledgerlens", driver_memory: str | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``.  What is not given comes from the
    launcher (``spark-submit``); only without any master does it run locally,
    on all cores, with a shuffle partition for each of eight threads."""
    launched = SparkConf().get("spark.master", None)
    builder = SparkSession.builder.appName(app_name)
    if master or not launched:
        builder = builder.master(master or "local[*]")
        if (master or "local").startswith("local"):
            shuffle_partitions, driver_memory = shuffle_partitions or 8, driver_memory or "16g"
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is configured.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local folder is used only for local
    masters (tests, the benchmark).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a folder on shared "
        "storage (HDFS, S3, ...) so checkpoints survive executor loss")
