"""File 08: executive and decision-making questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import AVG_4DP, dec, money, pct, ratio, raw_money
from ..functions import fixed as V
from .common import customer_subtotal, product_totals, with_cogs
from .selection import with_tiles
from .profit import territory_profit


def priority_products(detail: DataFrame, product: DataFrame, n: int = V.PRIORITY_PRODUCTS) -> DataFrame:
    """08.1 The ``n`` products with most revenue, with their order counts."""
    s = (detail.groupBy("ProductID")
         .agg(F.sum("LineTotal").alias("_rev"), F.count_distinct("SalesOrderID").alias("Orders")))
    return (s.join(product.select("ProductID", F.col("Name").alias("ProductName")), "ProductID")
            .select("ProductID", "ProductName", raw_money("_rev").alias("Revenue"), "Orders")
            .orderBy(F.desc("Revenue"), F.asc("ProductID")).limit(n))


def loyalty_candidates(header: DataFrame, customer: DataFrame, n: int = V.LOYALTY_CUSTOMERS,
                       min_orders: int = V.LOYALTY_MIN_ORDERS) -> DataFrame:
    """08.2 The ``n`` customers with most SubTotal among those with at least
    ``min_orders`` orders."""
    return (customer_subtotal(header, customer)
            .where(F.col("Orders") >= min_orders)
            .select("CustomerID", raw_money("Revenue").alias("Revenue"), "Orders")
            .orderBy(F.desc("Revenue"), F.asc("CustomerID")).limit(n))


def loss_making_territories(detail: DataFrame, header: DataFrame, product: DataFrame,
                            min_lines: int = V.LOSS_MIN_LINES, max_profit: int = V.LOSS_MAX_PROFIT) -> DataFrame:
    """08.3 Territories with more than ``min_lines`` lines and profit below
    ``max_profit``."""
    g = territory_profit(detail, header, product)
    profit = F.col("_r") - F.col("_c")
    return (g.where((F.col("_lines") > min_lines) & (profit < max_profit))
            .select("TerritoryID", F.col("_lines").cast("decimal(20,2)").alias("SalesVolume"),
                    money(profit).alias("Profit"))
            .orderBy(F.desc("Profit")))


def growth_drivers(header: DataFrame) -> DataFrame:
    """08.4 Orders, revenue and mean order value per year."""
    return (header.groupBy(F.year("OrderDate").alias("SalesYear"))
            .agg(F.count_distinct("SalesOrderID").alias("TotalOrders"),
                 money(F.sum("TotalDue")).alias("Revenue"),
                 ratio(F.sum("TotalDue"), F.count("TotalDue"), AVG_4DP, den_scale=0).alias("AOV"))
            .orderBy("SalesYear"))


def overstock_risk(detail: DataFrame, product: DataFrame, inventory: DataFrame,
                   max_orders: int = V.OVERSTOCK_MAX_UNITS, min_stock: int = V.OVERSTOCK_MIN_STOCK,
                   fan_out: bool = True) -> DataFrame:
    """08.5 Products selling fewer than ``max_orders`` units with more than
    ``min_stock`` units in stock.

    The reference joins lines to inventory rows of the same product, so each
    sum is multiplied by the other side's row count (literal default).  The
    same numbers come from one row per product on each side:
    units * inventory rows and stock * lines.  ``fan_out=False`` reports the
    plain sums.
    """
    s = detail.groupBy("ProductID").agg(F.sum("OrderQty").alias("_units"),
                                        F.count(F.lit(1)).alias("_lines"))
    i = inventory.groupBy("ProductID").agg(F.sum("Quantity").alias("_stock"),
                                           F.count(F.lit(1)).alias("_rows"))
    j = s.join(i, "ProductID").join(product.select("ProductID", "Name"), "ProductID")
    orders = F.col("_units") * F.col("_rows") if fan_out else F.col("_units")
    volume = F.col("_stock") * F.col("_lines") if fan_out else F.col("_stock")
    return (j.select("ProductID", "Name", orders.cast("long").alias("Orders"),
                     volume.cast("long").alias("iVolume"))
            .where((F.col("Orders") < max_orders) & (F.col("iVolume") > min_stock)))


def _name_profit(detail: DataFrame, product: DataFrame) -> DataFrame:
    return (with_cogs(product_totals(detail), product, "Name")
            .groupBy("Name").agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c"),
                                 F.sum("lines").alias("_lines")))


def loss_making_products(detail: DataFrame, product: DataFrame) -> DataFrame:
    """08.6 Product names with negative profit, worst first."""
    g = _name_profit(detail, product)
    profit = F.col("_r") - F.col("_c")
    return (g.where(profit < 0).select("Name", money(profit).alias("Profit"))
            .orderBy("Profit", "Name"))


def low_markup_high_volume(detail: DataFrame, product: DataFrame, max_markup: str = V.MARKUP_MAX,
                           min_lines: int = V.MARKUP_MIN_LINES) -> DataFrame:
    """08.7 Names whose markup (profit / COGS) is below ``max_markup`` with
    more than ``min_lines`` lines.  The markup test compares products, not a
    rounded quotient."""
    g = _name_profit(detail, product)
    r, c = F.col("_r"), F.col("_c")
    low = (F.when(c > 0, (r - c) < c * dec(max_markup))
           .when(c < 0, (r - c) > c * dec(max_markup)))
    return (g.where(low & (F.col("_lines") > min_lines))
            .select("Name", pct(r - c, c).alias("ProfitMarginPerc"), F.col("_lines").alias("Orders"))
            .orderBy("ProfitMarginPerc", "Name"))


def top_revenue_customers_tile(header: DataFrame, customer: DataFrame, tiles: int = V.TILES) -> DataFrame:
    """08.8 Customers in the first NTILE(tiles) by SubTotal."""
    clsv = customer_subtotal(header, customer).select("CustomerID", "Revenue")
    ranked = with_tiles(clsv, "CustomerID", {"RevenueGroup": ("Revenue", True)}, tiles)
    return (ranked.where(F.col("RevenueGroup") == 1)
            .select("CustomerID", raw_money("Revenue").alias("Revenue"), "RevenueGroup"))
