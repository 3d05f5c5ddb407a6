"""Sales facts stored for repeated analysis: bucketed by order, partitioned by month.

``store`` writes the canonical tables of any source into a database.  Order
header and detail get one layout:

* bucketed and sorted by ``SalesOrderID`` with the same bucket count, so a join
  of both on it (05.1, 05.3, 05.4, 05.6, ...) reads bucket against bucket and
  shuffles neither side;
* partitioned by the month of the order (``OrderMonth``, the order's month in
  the detail too), so a date bound lists only those months' files.

``StoredData`` offers the tables to the operators like the other sources.
``header`` and ``detail`` take a date bound; ``lines_of`` gives the lines of
some orders and lets their months prune the lines' files at run time.

Lines without an order are kept in a partition of their own (null month); an
order without a date too.  Tables are written once per call: ``store`` replaces
what a table of that name held.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .adapter import SALES_YTD_YEAR
from .tables import TableData

MONTH = "OrderMonth"


def _month(column: str):
    return F.trunc(F.col(column).cast("date"), "month")


def store(source, database: str, buckets: int, tables=tuple(schemas.ALL)) -> None:
    """Write ``tables`` of ``source`` as ``{database}.{table}``, the facts in
    ``buckets`` buckets (see ``bucket_count``)."""
    spark = source.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in tables:
        if name == "header":
            df = source.header(territory=True, ship_date=True).withColumn(MONTH, _month("OrderDate"))
        elif name == "detail":
            months = source.header().select("SalesOrderID", _month("OrderDate").alias(MONTH))
            df = source.detail().join(months, "SalesOrderID", "left")
        else:
            df = getattr(source, name)()
        df = df.select(*schemas.ALL[name].names, *([MONTH] if name in ("header", "detail") else []))
        if name in ("header", "detail"):
            # one task per bucket, so each month has one file of it
            writer = (df.repartition(buckets, "SalesOrderID").sortWithinPartitions(MONTH, "SalesOrderID").write
                      .partitionBy(MONTH).bucketBy(buckets, "SalesOrderID").sortBy("SalesOrderID"))
        else:
            writer = df.write
        writer.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def bucket_count(detail_bytes: int, bucket_bytes: int = 1 << 30) -> int:
    """Buckets of about ``bucket_bytes`` of lines over all months; a task of a
    join holds one.  A power of two, so that tables of different counts still
    meet without a shuffle (``spark.sql.bucketing.coalesceBucketsInJoin.enabled``)."""
    return 1 << max(0, (max(1, detail_bytes) - 1) // bucket_bytes).bit_length()


class StoredData(TableData):
    """The tables that ``store`` wrote into ``database``."""

    def __init__(self, spark: SparkSession, database: str):
        super().__init__(spark, database=database)

    def _facts(self, key: str, since: dt.date | None, until: dt.date | None) -> DataFrame:
        df = self.spark.table(f"{self.database}.{key}")
        if since is not None:
            df = df.where(F.col(MONTH) >= F.lit(since.replace(day=1)))
        if until is not None:
            df = df.where(F.col(MONTH) <= F.lit(until.replace(day=1)))
        return df

    def header(self, territory: bool = False, ship_date: bool = False, since: dt.date | None = None,
               until: dt.date | None = None) -> DataFrame:
        """Orders, with a bound those of ``since`` to ``until`` (days, both included)."""
        df = self._facts("header", since, until)
        day = F.col("OrderDate").cast("date")
        for bound, inside in ((since, day >= F.lit(since)), (until, day <= F.lit(until))):
            df = df if bound is None else df.where(inside)
        return df.select(*schemas.HEADER.names)

    def detail(self, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
        """Lines; with a bound those of the months that it touches, for joins
        with a header of the same bound."""
        return self._facts("detail", since, until).select(*schemas.DETAIL.names)

    def lines_of(self, orders) -> DataFrame:
        """Lines of the orders that satisfy the condition ``orders`` (a column or
        SQL text over the header); the orders' months prune the lines' files."""
        chosen = self._facts("header", None, None).where(orders).select("SalesOrderID", MONTH)
        lines = self._facts("detail", None, None)
        return (lines.join(chosen, ["SalesOrderID", MONTH], "left_semi")).select(*schemas.DETAIL.names)

    def territory(self) -> DataFrame:
        """Territories; SalesYTD read from the months of its year alone."""
        stored = self._table("territory").drop("SalesYTD")
        ytd = (self.header(since=dt.date(SALES_YTD_YEAR, 1, 1), until=dt.date(SALES_YTD_YEAR, 12, 31))
               .groupBy("TerritoryID").agg(F.sum("TotalDue").alias("ytd")))
        return stored.join(ytd, "TerritoryID", "left").select(
            "TerritoryID", "Name", F.coalesce("ytd", F.lit(0)).cast("decimal(18,2)").alias("SalesYTD"))
