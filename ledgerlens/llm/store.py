"""Tables written between the steps of an operator, and the input table."""

from __future__ import annotations

import atexit
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Spark removes the shuffle files of a finished write itself under this
#: setting, so the steps of an operator do not add up on the executors' disks.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_roots: dict[str, SparkSession] = {}


def _delete(spark: SparkSession, path: str) -> None:
    jvm = getattr(spark, "_jvm", None)
    if jvm is not None and spark.sparkContext._jsc is not None:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _forget() -> None:
    for path, spark in _roots.items():
        _delete(spark, path)
    _roots.clear()


atexit.register(_forget)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def tidy(spark: SparkSession):
    """Within: shuffle files go as soon as the query that wrote them ends."""
    return _setting(spark, _CLEAN, "true")


@contextmanager
def few_rows(spark: SparkSession, rows: int = 1):
    """Within: Parquet readers open and Python tasks get so many rows at a time,
    for tables of large rows."""
    with (_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)),
          _setting(spark, "spark.sql.parquet.columnarReaderBatchSize", str(rows))):
        yield


def pin(df: DataFrame, row_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: the lineage is cut, a lost executor costs no earlier step, and
    later readers prune columns.  The folder is deleted when the process ends.
    ``row_group``: bytes a writer gathers before it lets them go, for tables of
    large rows."""
    spark = df.sparkSession
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens-llm"
    path = f"{root}-{uuid.uuid4().hex}"
    _roots[path] = spark
    with tidy(spark):
        (df.write.option("parquet.block.size", row_group) if row_group else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.pinned_at = path
    return out


def unpin(*tables: DataFrame) -> None:
    """Delete pinned tables that nothing will read again: what was made of
    them has been pinned itself."""
    for df in tables:
        _delete(_roots.pop(df.pinned_at), df.pinned_at)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str, modulus: int, remainder: int):
    """crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder,
                      F.lit(False))


def sampled(rows: DataFrame, key: str, most: int) -> DataFrame:
    """All of ``rows`` where there are at most ``most``, else those under a
    limit on the hashed ``key`` that leaves just fewer: a filter, so no task
    and not the driver sees the rows of the others.  Keys are to be unique."""
    n = rows.count()
    if n <= most:
        return rows
    limit = int(0.97 * most / n * (1 << 32))
    return rows.where(F.pmod(F.xxhash64(key), F.lit(1 << 32)) < limit)
