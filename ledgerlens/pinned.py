"""Tables written to the checkpoint folder between the steps of a job."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

from .session import ensure_checkpoint_dir

_written: dict[str, SparkSession] = {}


def release() -> None:
    """Delete all pinned tables of this process (also done when it ends)."""
    for path, spark in _written.items():
        jvm = getattr(spark, "_jvm", None)
        if jvm is None or spark.sparkContext._jsc is None:
            continue
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    _written.clear()


atexit.register(release)


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Materialise ``df`` in the checkpoint folder (shared storage on a
    cluster) and read it back: a lineage cut that later readers can prune to
    the columns they need.  ``release`` deletes what was written."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    if not root:                       # Spark Connect without a folder name
        return df.checkpoint(eager=True)
    path = f"{root.rstrip('/')}/ledgerlens-{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
