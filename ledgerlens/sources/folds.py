"""Incremental folds: each input file is folded once, only new files are read.

The reports on years and months (02.1, 02.8, 07.2, 07.3, 07.9, 07.10) are
aggregates of aggregates: they need the order header only as sums per month,
or per customer and month.  ``HeaderFolds`` keeps these folds as Parquet, one
row per (file, month[, customer]), with the file's path, size and time of
change.  ``refresh`` lists the input, folds the files it has not seen in that
state and appends them; ``months`` and ``customer_months`` return header-like
rows that the operators take in place of the header:

    folds = HeaderFolds(spark, "s3://…/orders", "s3://…/folds", columns)
    folds.refresh()
    advanced.yoy_growth(folds.months())

A file that changed or went is no longer counted (its old rows are passed
over by state).  A refresh that fails half-way leaves rows without a mark in
``done``; they are passed over and the files folded again.  One writer at a
time: refreshes of one state folder are not to overlap.

The listing (path, size, time) is a Spark table; the driver gets only the
paths of new files, to read them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_STATE = ["file", "length", "changed"]


class HeaderFolds:
    """Folds of the order header stored under ``state``.

    ``files`` is a folder of Parquet files; ``columns`` maps CustomerID,
    OrderDate and TotalDue to SQL expressions over them (default: the columns
    of these names)."""

    def __init__(self, spark: SparkSession, files: str, state: str, columns: dict[str, str] | None = None):
        self.spark, self.files, self.state = spark, str(files).rstrip("/"), str(state).rstrip("/")
        self.columns = {c: c for c in ("CustomerID", "OrderDate", "TotalDue")} | (columns or {})

    def _listing(self) -> DataFrame:
        """The input's files as they are now; their content is not read."""
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
                .load(self.files).select("path", F.col("_metadata.file_path").alias("file"), "length",
                                         F.col("modificationTime").alias("changed")))

    def _stored(self, name: str) -> DataFrame | None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.state}/{name}")
        if not place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return None
        return self.spark.read.parquet(f"{self.state}/{name}")

    def pending(self) -> DataFrame:
        """Files not folded in their present state."""
        done = self._stored("done")
        listing = self._listing()
        return listing if done is None else listing.join(done, _STATE, "left_anti")

    def refresh(self) -> int:
        """Fold the pending files; how many they were."""
        pending = self.pending().collect()
        if not pending:
            return 0
        batch = uuid.uuid4().hex
        rows = self.spark.read.parquet(*[r.path for r in pending])
        header = rows.select(F.col("_metadata.file_path").alias("file"), *[F.expr(e).alias(c) for c, e in self.columns.items()])
        month = F.date_trunc("month", F.col("OrderDate").cast("timestamp_ntz")).cast("timestamp_ntz").alias("OrderDate")
        folded = (header.groupBy("file", month, "CustomerID")
                  .agg(F.sum("TotalDue").alias("TotalDue"), F.count(F.lit(1)).alias("Orders")))
        (folded.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.state}/customer_months"))
        written = self.spark.read.parquet(f"{self.state}/customer_months").where(F.col("batch") == batch)
        (written.groupBy("file", "OrderDate").agg(F.sum("TotalDue").alias("TotalDue"), F.sum("Orders").alias("Orders"))
         .withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{self.state}/months"))
        marks = self.spark.createDataFrame(pending).withColumn("batch", F.lit(batch))
        marks.coalesce(1).write.mode("append").parquet(f"{self.state}/done")
        return len(pending)

    def _current(self, name: str) -> DataFrame:
        """Folds of files in their present state."""
        done = self._stored("done")
        if done is None:
            raise ValueError(f"nothing folded under {self.state} yet: call refresh()")
        valid = done.join(self._listing(), _STATE, "left_semi").select("file", "batch")
        return self._stored(name).join(valid, ["file", "batch"], "left_semi")

    def months(self) -> DataFrame:
        """OrderDate (first of the month), TotalDue and Orders, a row per month."""
        return self._current("months").groupBy("OrderDate").agg(F.sum("TotalDue").alias("TotalDue"), F.sum("Orders").alias("Orders"))

    def customer_months(self) -> DataFrame:
        """The same per CustomerID."""
        return (self._current("customer_months").groupBy("CustomerID", "OrderDate")
                .agg(F.sum("TotalDue").alias("TotalDue"), F.sum("Orders").alias("Orders")))
