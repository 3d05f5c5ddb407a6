"""File 07: advanced analytics (ranks, growth, seasonality, RFM, Pareto,
rolling averages, anomalies)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import dec, money, month_start, pct, ratio, raw_money, timestamp_ntz
from ..functions import fixed as V
from .common import customer_subtotal, product_category, product_totals
from .ordered import with_rank
from .selection import with_running_sum_within, with_tiles


def rank_products_in_category(detail: DataFrame, product: DataFrame, subcategory: DataFrame,
                              category: DataFrame) -> DataFrame:
    """07.1 RANK of each product name by revenue within its category
    (ties share a rank, gaps follow).  Ranked with ``with_rank`` so one
    large category is spread over many tasks."""
    pc = product_category(product, subcategory, category)
    pr = (product_totals(detail).select("ProductID", "rev").join(pc, "ProductID")
          .groupBy("ProductName", "CategoryName").agg(F.sum("rev").alias("Revenue")))
    ranked = with_rank(pr, ["CategoryName"], "Revenue", "RNK", tie_break=["ProductName"])
    return ranked.select("ProductName", "CategoryName", raw_money("Revenue").alias("Revenue"), "RNK")


def _growth(df: DataFrame, keys: list[str]) -> DataFrame:
    # One row per year (or month): the window is bounded by the calendar.
    w = Window.orderBy(*keys)
    prev = F.lag("TotalSales").over(w)
    return (df.withColumn("_prev", prev)
            .withColumn("PrevYearSales", raw_money(F.coalesce(F.col("_prev"), F.lit(0))))
            .withColumn("GrowthRate", F.coalesce(pct(F.col("TotalSales") - F.col("_prev"),
                                                     F.col("_prev")), F.lit(0).cast("decimal(20,2)")))
            .withColumn("TotalSales", raw_money("TotalSales")))


def yoy_growth(header: DataFrame) -> DataFrame:
    """07.2 Yearly TotalDue and growth over the previous year row."""
    ys = header.groupBy(F.year("OrderDate").alias("SalesYear")).agg(F.sum("TotalDue").alias("TotalSales"))
    g = _growth(ys, ["SalesYear"])
    return g.select((F.col("SalesYear") - 1).alias("PrevSalesYear"), "SalesYear",
                    "PrevYearSales", "TotalSales", "GrowthRate")


def mom_growth(header: DataFrame) -> DataFrame:
    """07.3 Monthly TotalDue and growth over the previous month row; the
    'previous' labels are plain year-1 / month-1 as in the reference."""
    ms = (header.groupBy(F.year("OrderDate").alias("SalesYear"), F.month("OrderDate").alias("SalesMonth"))
          .agg(F.sum("TotalDue").alias("TotalSales")))
    g = _growth(ms, ["SalesYear", "SalesMonth"])
    return g.select((F.col("SalesYear") - 1).alias("PrevSalesYear"),
                    (F.col("SalesMonth") - 1).alias("PrevSalesMonth"),
                    "SalesYear", "SalesMonth", "PrevYearSales", "TotalSales", "GrowthRate")


def seasonality(header: DataFrame) -> DataFrame:
    """07.4 Mean order TotalDue per calendar month over all years."""
    return (header.groupBy(F.month("OrderDate").alias("SalesMonth"),
                           F.date_format("OrderDate", "MMMM").alias("MonthName"))
            .agg(ratio(F.sum("TotalDue"), F.count("TotalDue"), den_scale=0).alias("TotalSales"))
            .orderBy("SalesMonth"))


def rfm_scores(customer: DataFrame, header: DataFrame, as_of: dt.date | dt.datetime,
               tiles: int = V.TILES) -> DataFrame:
    """CustomerID, Recency, Frequency, Monetary, the three scores and RFM."""
    per_cust = (header.groupBy("CustomerID")
                .agg(F.max("OrderDate").alias("_last"),
                     F.count("SalesOrderID").alias("Frequency"),
                     F.sum("TotalDue").alias("Monetary")))
    rfm = (per_cust.join(customer.select("CustomerID"), "CustomerID", "left_semi")
           .withColumn("Recency", F.datediff(timestamp_ntz(as_of), F.col("_last")))
           .drop("_last"))
    rfm = with_tiles(rfm, "CustomerID", {"R_score": ("Recency", True), "F_score": ("Frequency", False),
                                         "M_score": ("Monetary", False)}, tiles)
    return rfm.withColumn("RFM", F.concat_ws("", "R_score", "F_score", "M_score"))


def _rfm_out(df: DataFrame) -> DataFrame:
    return (df.select("CustomerID", "Recency", "Frequency", raw_money("Monetary").alias("Monetary"), "RFM")
            .orderBy(F.desc("RFM"), F.asc("CustomerID")))


def rfm(customer: DataFrame, header: DataFrame, as_of: dt.date | dt.datetime,
        tiles: int = V.TILES) -> DataFrame:
    """07.5 Recency (days before ``as_of``), frequency and monetary value with
    NTILE scores (5 = best each) concatenated as the RFM code.  Ties in each
    ordering are broken by customer id."""
    return _rfm_out(rfm_scores(customer, header, as_of, tiles))


def churn_risk(customer: DataFrame, header: DataFrame, as_of: dt.date | dt.datetime,
               tiles: int = V.TILES, r_score: int = V.CHURN_R_SCORE) -> DataFrame:
    """07.6 The RFM rows with recency score ``r_score`` (filtered after the
    scores are computed over all customers)."""
    return _rfm_out(rfm_scores(customer, header, as_of, tiles).where(F.col("R_score") == r_score))


def _pareto(df: DataFrame, key: str, cutoff: Decimal | str) -> DataFrame:
    ranked = with_running_sum_within(df, key, "Revenue", cutoff)
    return (ranked.withColumn("CummulativeRevenuePercent", pct(F.col("_cum"), F.col("_total")))
            .withColumn("Revenue", money("Revenue")))


def pareto_products(detail: DataFrame, product: DataFrame,
                    cutoff: Decimal | str = V.PARETO_CUTOFF) -> DataFrame:
    """07.7 Products, by revenue, whose running share of revenue stays within
    ``cutoff``."""
    rev = (product_totals(detail).select("ProductID", F.col("rev").alias("Revenue"))
           .join(product.select("ProductID", F.col("Name").alias("ProductName")), "ProductID"))
    return (_pareto(rev, "ProductID", cutoff)
            .select("ProductID", "ProductName", "Revenue", "CummulativeRevenuePercent")
            .orderBy(F.desc("Revenue"), F.asc("ProductID")))


def pareto_customers(header: DataFrame, customer: DataFrame,
                     cutoff: Decimal | str = V.PARETO_CUTOFF) -> DataFrame:
    """07.8 Customers, by SubTotal, whose running share stays within ``cutoff``."""
    rev = customer_subtotal(header, customer).select("CustomerID", "Revenue")
    return (_pareto(rev, "CustomerID", cutoff)
            .select("CustomerID", "Revenue", "CummulativeRevenuePercent")
            .orderBy(F.desc("Revenue"), F.asc("CustomerID")))


def _monthly_rolling(header: DataFrame, window: int) -> DataFrame:
    ms = (header.groupBy(month_start("OrderDate").alias("SalesMonth"))
          .agg(money(F.sum("TotalDue")).alias("TotalSales")))
    # One row per month: a global window over the calendar is bounded.
    w = Window.orderBy("SalesMonth").rowsBetween(-(window - 1), 0)
    return ms.withColumn("Rolling3MonthAvgSales",
                         ratio(F.sum("TotalSales").over(w), F.count("TotalSales").over(w), den_scale=0))


def rolling_avg_sales(header: DataFrame, window: int = V.ROLLING_MONTHS) -> DataFrame:
    """07.9 Monthly TotalDue and its mean over the current and previous
    ``window - 1`` month rows."""
    return _monthly_rolling(header, window)


def sales_anomalies(header: DataFrame, window: int = V.ROLLING_MONTHS, low: str = V.DROP_BELOW,
                    high: str = V.SPIKE_ABOVE) -> DataFrame:
    """07.10 07.9 plus deviation % from the rolling mean and a status."""
    r = _monthly_rolling(header, window)
    ts, avg = F.col("TotalSales"), F.col("Rolling3MonthAvgSales")
    status = (F.when(ts < avg * dec(low), F.lit(V.STATUS_DROP))
              .when(ts > avg * dec(high), F.lit(V.STATUS_SPIKE))
              .otherwise(F.lit(V.STATUS_NORMAL)))
    return r.select("SalesMonth", "TotalSales", "Rolling3MonthAvgSales",
                    pct(ts - avg, avg).alias("DeviationRate"), status.alias("SalesStatus"))
