"""File 02: customer analytics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import MONEY, month_start, pct, ratio, raw_money, segment, timestamp_ntz
from ..functions import fixed as V


def new_customers_by_year(header: DataFrame) -> DataFrame:
    """02.1 Customers counted in the year of their first order."""
    first = header.groupBy("CustomerID").agg(F.min(F.year("OrderDate")).alias("YEAR"))
    return (first.groupBy("YEAR").agg(F.count("CustomerID").alias("NewCustomers"))
            .orderBy("YEAR"))


def yearly_retention(header: DataFrame) -> DataFrame:
    """02.2 Customers active in a year and how many of them buy again the
    next calendar year.

    The reference LEFT-joins distinct (customer, year) rows to themselves on
    ``year + 1``; a ``lead`` over each customer's years gives the same match
    with one shuffle instead of two (the window holds one customer's years).
    """
    cy = header.select("CustomerID", F.year("OrderDate").alias("YEAR")).distinct()
    w = Window.partitionBy("CustomerID").orderBy("YEAR")
    retained = F.when(F.lead("YEAR").over(w) == F.col("YEAR") + 1, 1).otherwise(0)
    g = (cy.withColumn("_kept", retained)
         .groupBy(F.col("YEAR").alias("PrevYears"))
         .agg(F.count("CustomerID").alias("LastYearCustomers"),
              F.sum("_kept").cast("long").alias("RetainedCustomers")))
    return (g.where(F.col("LastYearCustomers") > 0)
            .select("PrevYears", "LastYearCustomers", "RetainedCustomers",
                    pct(F.col("RetainedCustomers"), F.col("LastYearCustomers"),
                        num_scale=0, den_scale=0).alias("RetentionRate"))
            .orderBy("PrevYears"))


def lapsed_customers(customer: DataFrame, header: DataFrame, as_of: dt.date | dt.datetime,
                     months: int = V.LAPSE_MONTHS) -> DataFrame:
    """02.3 Customers whose last order is older than ``months`` before
    ``as_of`` (the reference uses the current time), or who never ordered."""
    last = header.groupBy("CustomerID").agg(F.max("OrderDate").alias("DATE"))
    cutoff = timestamp_ntz(as_of) - F.expr(f"INTERVAL {int(months)} MONTHS")
    return (customer.select("CustomerID").distinct()
            .join(last, "CustomerID", "left")
            .where((F.col("DATE") < cutoff) | F.col("DATE").isNull())
            .orderBy("CustomerID"))


def avg_purchase_frequency(header: DataFrame) -> DataFrame:
    """02.4 Orders per distinct customer."""
    return header.agg(ratio(F.count(F.lit(1)), F.count_distinct("CustomerID"),
                            num_scale=0, den_scale=0).alias("Avg_Purc"))


def _segments(customer: DataFrame) -> DataFrame:
    return customer.select("CustomerID", segment().alias("Segments"))


def revenue_by_segment(header: DataFrame, customer: DataFrame) -> DataFrame:
    """02.5 TotalDue per customer segment (Store / Individual / Unknown)."""
    per_cust = header.groupBy("CustomerID").agg(F.sum("TotalDue").alias("_rev"))
    return (per_cust.join(_segments(customer), "CustomerID")
            .groupBy("Segments").agg(raw_money(F.sum("_rev")).alias("Revenue")))


def clv_by_segment(header: DataFrame, customer: DataFrame) -> DataFrame:
    """02.6 Mean of AOV * lifetime * frequency per segment, lifetime in
    360-day years (1.0 when first and last order share a day).  Evaluated in
    double like the reference, rounded last; algebraically the mean revenue
    per customer."""
    per_cust = (header.groupBy("CustomerID")
                .agg(F.sum("TotalDue").alias("revenue"),
                     F.count("SalesOrderID").alias("orders"),
                     F.min("OrderDate").alias("FirstDate"),
                     F.max("OrderDate").alias("SecondDate")))
    days = F.datediff(F.col("SecondDate"), F.col("FirstDate"))
    lifetime = F.when(days == 0, F.lit(1.0)).otherwise(days.cast("double") / F.lit(float(V.DAYS_PER_YEAR)))
    aov = F.col("revenue").cast("double") / F.col("orders").cast("double")
    frequency = F.col("orders").cast("double") / lifetime
    clv = aov * lifetime * frequency
    return (per_cust.join(_segments(customer), "CustomerID")
            .groupBy("Segments").agg(F.avg(clv).cast(MONEY).alias("AOV_CLV_Segments")))


def top_repeat_customers(header: DataFrame, n: int = V.TOP_REPEAT_CUSTOMERS,
                         min_orders_exclusive: int = V.REPEAT_MIN_ORDERS_EXCLUSIVE) -> DataFrame:
    """02.7 The ``n`` customers with most SubTotal among those with more
    than ``min_orders_exclusive`` orders."""
    g = header.groupBy("CustomerID").agg(F.count("SalesOrderID").alias("Orders"),
                                         raw_money(F.sum("SubTotal")).alias("Revenue"))
    return (g.where(F.col("Orders") > min_orders_exclusive)
            .orderBy(F.desc("Revenue"), F.asc("CustomerID")).limit(n))


def consecutive_month_streaks(header: DataFrame, min_len: int = V.STREAK_MIN_MONTHS,
                              distinct_months: bool = False) -> DataFrame:
    """02.8 Longest run of consecutive order months per customer, kept when
    at least ``min_len``.

    The reference numbers islands with a running sum of "previous order's
    month is not last month" over the orders sorted by month.  A second order
    in the same month sees its own month as previous, so it opens a new
    island, and the default RANGE frame gives all orders of a month the same
    island id; the island's size counts orders.  Folding orders to (customer,
    month, k orders) reproduces that exactly and order-independently: the
    month adds (first order breaks ? 1 : 0) + (k - 1) to the island id.
    ``distinct_months=True`` counts months instead (k = 1).
    """
    months = (header.groupBy("CustomerID", month_start("OrderDate").alias("LoginMonth"))
              .agg(F.count(F.lit(1)).alias("_k")))
    if distinct_months:
        months = months.withColumn("_k", F.lit(1).cast("long"))
    w = Window.partitionBy("CustomerID").orderBy("LoginMonth")
    breaks = F.when(F.lag("LoginMonth").over(w) == F.add_months("LoginMonth", -1), 0).otherwise(1)
    islands = (months.withColumn("_inc", breaks + F.col("_k") - 1)
               .withColumn("_island", F.sum("_inc").over(w.rowsBetween(Window.unboundedPreceding, 0)))
               .groupBy("CustomerID", "_island")
               .agg(F.sum("_k").alias("ConsecutiveMonths")))
    return (islands.groupBy("CustomerID")
            .agg(F.max("ConsecutiveMonths").cast("long").alias("MaxConsecutiveMonths"))
            .where(F.col("MaxConsecutiveMonths") >= min_len)
            .orderBy(F.desc("MaxConsecutiveMonths"), F.asc("CustomerID")))
