"""File 06: geographic and territory insights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import money, pct, ratio, raw_money


def sales_by_geography(header: DataFrame, address: DataFrame, state: DataFrame,
                       country: DataFrame) -> DataFrame:
    """06.1 SubTotal per ship-to country, state and city."""
    per_address = (header.groupBy(F.col("ShipToAddressID").alias("AddressID"))
                   .agg(F.sum("SubTotal").alias("_s")))
    geo = (address.select("AddressID", "City", "StateProvinceID")
           .join(state.select("StateProvinceID", F.col("Name").alias("State"), "CountryRegionCode"),
                 "StateProvinceID")
           .join(country.select("CountryRegionCode", F.col("Name").alias("Country")),
                 "CountryRegionCode"))
    return (per_address.join(geo, "AddressID")
            .groupBy("Country", "State", "City").agg(money(F.sum("_s")).alias("Revenue"))
            .orderBy("Country", "State", "City", F.desc("Revenue")))


def region_year_revenue(header: DataFrame, territory: DataFrame) -> DataFrame:
    """Region, YEAR, Revenue: TotalDue per territory name and order year."""
    per_tid = (header.groupBy("TerritoryID", F.year("OrderDate").alias("YEAR"))
               .agg(F.sum("TotalDue").alias("_rev")))
    names = territory.select("TerritoryID", F.col("Name").alias("Region"))
    return (per_tid.join(names, "TerritoryID")
            .groupBy("Region", "YEAR").agg(F.sum("_rev").alias("Revenue")))


def region_yoy_growth(header: DataFrame, territory: DataFrame) -> DataFrame:
    """06.2 Revenue growth % of each region over its previous year row."""
    ry = region_year_revenue(header, territory)
    w = Window.partitionBy("Region").orderBy("YEAR")
    g = ry.withColumn("PrevRevenue", F.lag("Revenue").over(w))
    return (g.where(F.col("PrevRevenue").isNotNull())
            .select("Region", "YEAR", raw_money("PrevRevenue").alias("PrevRevenue"),
                    raw_money("Revenue").alias("Revenue"),
                    pct(F.col("Revenue") - F.col("PrevRevenue"), F.col("PrevRevenue")).alias("Growth"))
            .orderBy(F.desc("Growth")))


def region_overall_growth(header: DataFrame, territory: DataFrame) -> DataFrame:
    """06.3 Growth from each region's first to last year.  The reference joins
    the region-year table twice; ``min_by`` / ``max_by`` read both revenues in
    the same aggregation."""
    ry = region_year_revenue(header, territory)
    b = ry.groupBy("Region").agg(
        F.min("YEAR").alias("FirstYear"), F.max("YEAR").alias("LastYear"),
        F.min_by("Revenue", "YEAR").alias("_first"), F.max_by("Revenue", "YEAR").alias("_last"))
    return (b.select("Region", "FirstYear", "LastYear",
                     raw_money("_first").alias("FirstYearRevenue"),
                     raw_money("_last").alias("CurrentYearRevenue"),
                     pct(F.col("_last") - F.col("_first"), F.col("_first")).alias("GrowthRate"))
            .orderBy(F.desc("GrowthRate")))


def region_average_order_value(header: DataFrame, territory: DataFrame) -> DataFrame:
    """06.4 TotalDue per order, per region."""
    per_tid = header.groupBy("TerritoryID").agg(F.sum("TotalDue").alias("_s"),
                                                F.count("SalesOrderID").alias("_n"))
    names = territory.select("TerritoryID", F.col("Name").alias("Region"))
    g = per_tid.join(names, "TerritoryID").groupBy("Region").agg(F.sum("_s").alias("_s"),
                                                                 F.sum("_n").alias("_n"))
    return (g.select("Region", ratio(F.col("_s"), F.col("_n"), den_scale=0).alias("AOV"))
            .orderBy(F.desc("AOV")))


def expansion_candidates(detail: DataFrame, header: DataFrame, territory: DataFrame,
                         order_grain: bool = False) -> DataFrame:
    """06.5 Units, sales and mean yearly growth per region.

    The reference joins each order's TotalDue to its lines, so an order's
    total counts once per line (literal default).  Lines are folded to
    (order, lines, units) first and the total is weighted by the line count,
    which gives the same sums without the line-grain join;
    ``order_grain=True`` counts each order's total once.
    Demand and growth both come from one region-year aggregate, in one
    aggregation (no self-join of the CTEs).
    """
    per_order = detail.groupBy("SalesOrderID").agg(F.count(F.lit(1)).alias("_lines"),
                                                    F.sum("OrderQty").alias("_qty"))
    orders = header.select("SalesOrderID", "TerritoryID", F.year("OrderDate").alias("SalesYear"),
                           "TotalDue")
    weight = F.col("TotalDue") if order_grain else F.col("TotalDue") * F.col("_lines")
    per_tid = (orders.join(per_order, "SalesOrderID")
               .groupBy("TerritoryID", "SalesYear")
               .agg(F.sum("_qty").alias("_qty"), F.sum(weight).alias("_sales")))
    names = territory.select("TerritoryID", F.col("Name").alias("Region"))
    ry = (per_tid.join(names, "TerritoryID")
          .groupBy("Region", "SalesYear")
          .agg(F.sum("_qty").alias("_qty"), F.sum("_sales").alias("_sales")))
    # Demand (per region) LEFT JOIN GrowthCalc (per region-year) grouped back
    # by region is one aggregation over the region-year rows once each row
    # carries its growth over the previous year row (window bounded by years).
    w = Window.partitionBy("Region").orderBy("SalesYear")
    prev = F.lag("_sales").over(w)
    growth = ry.withColumn("_growth", pct(F.col("_sales") - prev, prev))
    return (growth.groupBy("Region")
            .agg(F.sum("_qty").cast("long").alias("TotalOrders"),
                 money(F.sum("_sales")).alias("TotalSales"),
                 ratio(F.sum("_growth"), F.count("_growth"), den_scale=0).alias("AvgGrowthRate"))
            .orderBy(F.desc("AvgGrowthRate"), F.desc("TotalSales")))
