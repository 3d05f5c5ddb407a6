"""File 05: profitability and cost."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import AVG_4DP, money, pct, ratio
from ..functions import fixed as V
from .common import order_line_totals, product_category, product_totals, with_cogs


def _lines_with_year(detail: DataFrame, header: DataFrame) -> DataFrame:
    years = header.select("SalesOrderID", F.year("OrderDate").alias("Years"))
    return detail.join(years, "SalesOrderID")


def gross_profit_by_product_category_year(detail: DataFrame, header: DataFrame, product: DataFrame,
                                          subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """05.1 Revenue, COGS and gross profit per product, category and order year."""
    pc = product_category(product, subcategory, category)
    totals = product_totals(_lines_with_year(detail, header), "Years")
    g = (with_cogs(totals, pc, "ProductName", "CategoryName")
         .groupBy("ProductName", F.col("CategoryName").alias("ProductCategory"), "Years")
         .agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c")))
    return (g.select("ProductName", "ProductCategory", "Years",
                     money("_r").alias("Revenue"), money("_c").alias("COGS"),
                     money(F.col("_r") - F.col("_c")).alias("GrossProfit"))
            .orderBy("Years", "ProductCategory", F.desc("GrossProfit"), "ProductName"))


def _margin(g: DataFrame) -> DataFrame:
    """Margin % = (revenue - COGS) * 100 / revenue of positive lines."""
    return g.withColumn("GrossProfitMargin", pct(F.col("_r") - F.col("_c"), F.col("_p")))


def _name_totals(totals: DataFrame, product: DataFrame, *keys) -> DataFrame:
    return (with_cogs(totals, product, "Name")
            .groupBy(F.col("Name").alias("ProductName"), *keys)
            .agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c"), F.sum("pos_rev").alias("_p")))


def negative_margin_products(detail: DataFrame, product: DataFrame) -> DataFrame:
    """05.2 Product names whose 2-decimal gross margin is negative."""
    g = _margin(_name_totals(product_totals(detail), product))
    return (g.where(F.col("GrossProfitMargin") < 0)
            .select("ProductName", money("_r").alias("Revenue"), money("_c").alias("COGS"),
                    "GrossProfitMargin")
            .orderBy("GrossProfitMargin", "ProductName"))


def shrinking_margins(detail: DataFrame, header: DataFrame, product: DataFrame) -> DataFrame:
    """05.3 Product-years whose margin is below the previous row's."""
    totals = product_totals(_lines_with_year(detail, header), "Years")
    g = _margin(_name_totals(totals, product, "Years"))
    w = Window.partitionBy("ProductName").orderBy("Years")
    trend = g.withColumn("PrevProfitMargin", F.lag("GrossProfitMargin").over(w))
    return (trend.where((F.col("GrossProfitMargin") < F.col("PrevProfitMargin"))
                        & F.col("PrevProfitMargin").isNotNull())
            .select("ProductName", "Years", "PrevProfitMargin",
                    F.col("GrossProfitMargin").alias("CurrentProfitMargin"))
            .orderBy("ProductName", "Years"))


def discount_margin_effect(detail: DataFrame, header: DataFrame, product: DataFrame,
                           fractional_discount: bool = False) -> DataFrame:
    """05.4 Average price, cost, discounted price and margin rates per name.

    Literally the discounted price is ``UnitPrice * 1 - UnitPriceDiscount``
    (price minus the discount); ``fractional_discount=True`` uses
    ``UnitPrice * (1 - UnitPriceDiscount)``.  Averages are at line grain;
    the margin rates are ratios of averages, i.e. of sums.
    """
    price, disc = F.col("UnitPrice"), F.col("UnitPriceDiscount")
    discounted = price * (F.lit(1) - disc) if fractional_discount else price * F.lit(1) - disc
    lines = detail.join(header.select("SalesOrderID"), "SalesOrderID", "left_semi")
    per_product = (lines.groupBy("ProductID")
                   .agg(F.count("UnitPrice").alias("_n"), F.sum(price).alias("_up"),
                        F.sum(discounted).alias("_dp")))
    g = (per_product.join(product.select("ProductID", "Name", "StandardCost"), "ProductID")
         .groupBy("Name")
         .agg(F.sum("_n").alias("_n"), F.sum("_up").alias("_up"), F.sum("_dp").alias("_dp"),
              F.sum(F.col("StandardCost") * F.col("_n")).alias("_cost")))
    n, up, dp, cost = F.col("_n"), F.col("_up"), F.col("_dp"), F.col("_cost")
    dscale = 10 if fractional_discount else 8   # decimals of the discounted price
    return g.select(
        "Name",
        ratio(up, n, AVG_4DP, 8, 0).alias("AvgPrice"),
        ratio(cost, n, AVG_4DP, 4, 0).alias("AvgCost"),
        ratio(dp, n, AVG_4DP, dscale, 0).alias("AvgDiscountedPrice"),
        pct(up - cost, up, num_scale=8, den_scale=8).alias("MarginRateWithoutDiscount"),
        pct(dp - cost, dp, num_scale=dscale, den_scale=dscale).alias("MarginRateWithDiscount"))


def _order_profit(detail: DataFrame, header: DataFrame, product: DataFrame, key: str) -> DataFrame:
    per_order = order_line_totals(detail, product)
    return (header.select("SalesOrderID", key).join(per_order, "SalesOrderID")
            .groupBy(key).agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c"),
                              F.sum("lines").alias("_lines")))


def territory_profit(detail: DataFrame, header: DataFrame, product: DataFrame) -> DataFrame:
    """TerritoryID, _r, _c, _lines.  Lines meet their order once and are folded
    to (territory, product), a small table, before the cost is joined."""
    folded = (detail.join(header.select("SalesOrderID", "TerritoryID"), "SalesOrderID")
              .groupBy("TerritoryID", "ProductID")
              .agg(F.sum("LineTotal").alias("rev"), F.sum("OrderQty").alias("qty"), F.count(F.lit(1)).alias("lines")))
    return (with_cogs(folded, product).groupBy("TerritoryID")
            .agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c"), F.sum("lines").alias("_lines")))


def profit_per_customer(detail: DataFrame, header: DataFrame, product: DataFrame) -> DataFrame:
    """05.5 Revenue minus COGS per customer."""
    g = _order_profit(detail, header, product, "CustomerID")
    return (g.select("CustomerID", money(F.col("_r") - F.col("_c")).alias("Profit"))
            .orderBy(F.desc("Profit"), F.asc("CustomerID")))


def high_revenue_low_profit_territories(detail: DataFrame, header: DataFrame, product: DataFrame,
                                        min_revenue: int = V.HIGH_REVENUE_MIN,
                                        max_profit: int = V.LOW_PROFIT_MAX) -> DataFrame:
    """05.6 Territories with revenue above ``min_revenue`` and profit below
    ``max_profit`` (unrounded sums)."""
    g = territory_profit(detail, header, product)
    profit = F.col("_r") - F.col("_c")
    return (g.where((F.col("_r") > min_revenue) & (profit < max_profit))
            .select("TerritoryID", money("_r").alias("Revenue"), money("_c").alias("COGS"),
                    money(profit).alias("Profit"))
            .orderBy(F.desc("Profit")))
