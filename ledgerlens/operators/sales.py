"""File 01: sales performance and revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MONEY_1DP, money, pct, ratio, raw_money
from ..functions import fixed as V
from .common import customer_line_value
from .selection import with_tiles


def revenue_by_period(detail: DataFrame, date_col: str = "ModifiedDate") -> DataFrame:
    """01.1 Revenue per year, quarter and month of ``date_col``."""
    d = F.col(date_col)
    return (detail.groupBy(F.year(d).alias("Year"), F.quarter(d).alias("QUARTER"),
                           F.month(d).alias("Month"))
            .agg(money(F.sum("LineTotal")).alias("TotalRevenue"))
            .orderBy("Year", "QUARTER", "Month"))


def top_product_by_revenue(product: DataFrame, detail: DataFrame, n: int = V.TOP_PRODUCTS) -> DataFrame:
    """01.2 The ``n`` products with the highest revenue (ties by id)."""
    rev = detail.groupBy("ProductID").agg(F.sum("LineTotal").alias("rev"))
    return (rev.join(product.select("ProductID", "Name"), "ProductID")
            .select(F.col("ProductID").alias("ID"), F.col("Name").alias("name"),
                    F.round("rev", 2).cast("decimal(38,2)").alias("revenue"))
            .orderBy(F.desc("revenue"), F.asc("ID")).limit(n))


def top_customers_by_lifetime_sales(header: DataFrame, customer: DataFrame, detail: DataFrame,
                                    n: int = V.TOP_CUSTOMERS) -> DataFrame:
    """01.3 The ``n`` customers with the highest lifetime line value."""
    return (customer_line_value(header, customer, detail)
            .select("ID", raw_money("LSV").alias("LSV"))
            .orderBy(F.desc("LSV"), F.asc("ID")).limit(n))


def average_order_value_by_year(detail: DataFrame, distinct_orders: bool = False,
                                date_col: str = "ModifiedDate") -> DataFrame:
    """01.4 Sum of LineTotal / count of SalesOrderID per year.

    Literally the count is of lines (an average line value);
    ``distinct_orders=True`` divides by distinct orders instead."""
    orders = F.count_distinct("SalesOrderID") if distinct_orders else F.count("SalesOrderID")
    return (detail.groupBy(F.year(date_col).alias("Year"))
            .agg(F.sum("LineTotal").alias("_rev"), orders.alias("_n"))
            .select(ratio(F.col("_rev"), F.col("_n"), den_scale=0).alias("AOV"), "Year")
            .orderBy("Year"))


def online_share_by_month(header: DataFrame, date_col: str = "ModifiedDate") -> DataFrame:
    """01.5 Monthly sales, the online part, and its percentage."""
    online = F.when(F.col("OnlineOrderFlag"), F.col("SubTotal")).otherwise(F.lit(0))
    g = (header.groupBy(F.year(date_col).alias("Year"), F.month(date_col).alias("MONTH"))
         .agg(F.sum("SubTotal").alias("_s"), F.sum(online).alias("_o")))
    return (g.select("Year", "MONTH",
                     F.col("_s").cast(MONEY_1DP).alias("sales"),
                     F.col("_o").cast(MONEY_1DP).alias("onlinesales"),
                     pct(F.col("_o"), F.col("_s")).alias("%onlinesales"))
            .orderBy("Year", "MONTH"))


def revenue_by_territory(territory: DataFrame) -> DataFrame:
    """01.6 Stored year-to-date sales per territory name."""
    return (territory.groupBy(F.col("Name").alias("Territory"))
            .agg(raw_money(F.sum("SalesYTD")).alias("Revenue"))
            .orderBy(F.desc("Revenue")))


def top_quintile_revenue_share(header: DataFrame, customer: DataFrame, detail: DataFrame,
                               tiles: int = V.TILES) -> DataFrame:
    """01.7 Share of revenue from the first NTILE(tiles) of customers by
    lifetime value, formatted 'NN.NN%'."""
    clsv = customer_line_value(header, customer, detail)
    ranked = with_tiles(clsv, "ID", {"RNK": ("LSV", True)}, tiles)
    top = F.sum(F.when(F.col("RNK") == 1, F.col("LSV")).otherwise(F.lit(0)))
    share = pct(top, F.sum("LSV"))
    return ranked.agg(F.concat_ws("", share.cast("string"), F.lit(V.PERCENT_SUFFIX)).alias("TOP20%Revenue"))


def declining_products(product: DataFrame, detail: DataFrame, date_col: str = "ModifiedDate") -> DataFrame:
    """01.8 Product-years whose revenue fell two years running (previous
    rows, not previous calendar years)."""
    psv = (detail.groupBy("ProductID", F.year(date_col).alias("Year"))
           .agg(F.sum("LineTotal").alias("_rev"))
           .join(product.select("ProductID", "Name"), "ProductID")
           .select(F.col("ProductID").alias("ID"), "Name", "Year",
                   F.round("_rev", 2).cast("decimal(38,2)").alias("CurrentYear")))
    w = Window.partitionBy("ID").orderBy("Year")
    trend = (psv.withColumn("LastYear", F.lag("CurrentYear", 1).over(w))
             .withColumn("TwoYearsAgo", F.lag("CurrentYear", 2).over(w)))
    return (trend.where((F.col("CurrentYear") < F.col("LastYear"))
                        & (F.col("LastYear") < F.col("TwoYearsAgo")))
            .select("ID", "Name", "CurrentYear", "LastYear", "TwoYearsAgo"))
