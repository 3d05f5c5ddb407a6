"""File 03: product and inventory analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import MONEY, pct, ratio, raw_money
from ..functions import fixed as V
from .basket import named_co_occurrence
from .common import product_category, product_totals, with_cogs


def list_price_margin(product: DataFrame) -> DataFrame:
    """03.1 (ListPrice - StandardCost) * 100 / ListPrice; NULL for ListPrice <= 0."""
    price = F.col("ListPrice")
    margin = pct(price - F.col("StandardCost"), F.when(price > 0, price), "decimal(20,4)")
    return (product.select("Name", "ListPrice", margin.alias("ProfitMargin"))
            .orderBy(F.col("ProfitMargin").desc_nulls_last(), "Name"))


def products_bought_together(detail: DataFrame, product: DataFrame,
                             distinct_orders: bool = False) -> DataFrame:
    """03.2 Product-name pairs (higher id first) and how many line pairs of
    one order they share; ``distinct_orders=True`` counts orders instead.

    Pairs are formed and folded on ids; names are joined to the folded pairs
    and the counts added up by name (names may repeat across ids)."""
    pairs = named_co_occurrence(detail, product, "SalesOrderID", "ProductID", "Name", distinct_baskets=distinct_orders)
    return pairs.select(F.col("name_a").alias("Product1"), F.col("name_b").alias("Product2"), F.col("pairs").alias("No_PurchasedTogether"))


def _units_sold(detail: DataFrame) -> DataFrame:
    return detail.groupBy("ProductID").agg(F.sum("OrderQty").alias("Orders"))


def _stock(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("ProductID").agg(F.sum("Quantity").alias("iQty"))


def overstocked_low_sellers(detail: DataFrame, product: DataFrame, inventory: DataFrame,
                            max_orders: int = V.LOW_SELLER_MAX_UNITS) -> DataFrame:
    """03.3 Products selling fewer than ``max_orders`` units whose stock
    exceeds the integer mean quantity per inventory row."""
    # one aggregate per product serves both the stock and (folded) the mean row: both
    # readers keep its columns and neither filters below it, so Spark reuses the exchange
    stock = inventory.groupBy("ProductID").agg(F.sum("Quantity").alias("iQty"), F.count(F.lit(1)).alias("_rows"))
    mean_row = stock.agg(F.expr("sum(iQty) div nullif(sum(_rows), 0)").alias("_mean"))
    names = product.select("ProductID", "Name")
    sold = _units_sold(detail).where(F.col("Orders") < max_orders)
    held = stock.where("_rows > 0").withColumnRenamed("ProductID", "_pid")
    return (sold.join(held, F.col("ProductID").eqNullSafe(F.col("_pid")))
            .join(names, "ProductID")
            .crossJoin(F.broadcast(mean_row))          # one-row scalar
            .where(F.col("iQty") > F.col("_mean"))
            .select("ProductID", "Name", F.col("Orders").cast("long").alias("Orders"),
                    F.col("iQty").cast("long").alias("iQty")))


def inventory_turnover(detail: DataFrame, product: DataFrame, inventory: DataFrame) -> DataFrame:
    """03.4 Units sold / units in stock per sold product (NULL without stock)."""
    names = product.select("ProductID", "Name")
    q = F.col("iQty")
    return (_units_sold(detail).join(names, "ProductID")
            .join(_stock(inventory), "ProductID", "left")
            .select("ProductID", "Name", F.col("Orders").cast("long").alias("Orders"),
                    q.cast("long").alias("iQty"),
                    ratio(F.col("Orders"), F.when(q > 0, q), MONEY, 0, 0).alias("TurnOverRate")))


def below_reorder_point(inventory: DataFrame, product: DataFrame) -> DataFrame:
    """03.5 Stocked products out of stock or below their reorder point."""
    p = product.select("ProductID", "Name", "ReorderPoint")
    return (_stock(inventory).join(p, "ProductID")
            .where((F.col("iQty") == 0) | (F.col("iQty") < F.col("ReorderPoint")))
            .select("ProductID", "Name", F.col("iQty").cast("long").alias("iQty"), "ReorderPoint"))


def category_profit(detail: DataFrame, product: DataFrame, subcategory: DataFrame,
                    category: DataFrame) -> DataFrame:
    """03.6 Revenue, COGS and profit per product category."""
    pc = product_category(product, subcategory, category)
    g = (with_cogs(product_totals(detail), pc, "CategoryName")
         .groupBy(F.col("CategoryName").alias("Name"))
         .agg(F.sum("rev").alias("_r"), F.sum("cogs").alias("_c")))
    return (g.select("Name", raw_money("_r").alias("Revenue"), raw_money("_c").alias("COGS"),
                     raw_money(F.col("_r") - F.col("_c")).alias("Profit"))
            .orderBy(F.desc("Profit")))


def product_recommendation(detail: DataFrame, product: DataFrame,
                           discontinue_units: int = V.DISCONTINUE_MAX_UNITS,
                           discontinue_profit: int = V.DISCONTINUE_MAX_PROFIT,
                           promote_units: int = V.PROMOTE_MIN_UNITS,
                           promote_profit: int = V.PROMOTE_MIN_PROFIT) -> DataFrame:
    """03.7 Discontinue / promote / monitor per product name, unsold
    products included."""
    sold = product_totals(detail).select("ProductID", "rev", "qty")
    perf = (product.select("ProductID", "Name", "StandardCost")
            .join(sold, "ProductID", "left")
            .groupBy("Name")
            .agg(F.sum("rev").alias("Revenue"),
                 F.sum(F.col("StandardCost") * F.col("qty")).alias("COGS"),
                 F.sum("qty").alias("UnitSold"))
            .withColumn("Profit", F.col("Revenue") - F.col("COGS")))
    units, profit = F.col("UnitSold"), F.col("Profit")
    rec = (F.when(((units < discontinue_units) & (profit < discontinue_profit))
                  | F.col("Revenue").isNull(), F.lit(V.RECOMMEND_DISCONTINUE))
           .when((units > promote_units) & (profit > promote_profit), F.lit(V.RECOMMEND_PROMOTE))
           .otherwise(F.lit(V.RECOMMEND_MONITOR)))
    return (perf.select("Name", F.coalesce(units, F.lit(0)).cast("long").alias("UnitSold"),
                        raw_money(F.coalesce(profit, F.lit(0))).alias("Profit"),
                        rec.alias("Recommendation"))
            .orderBy(F.desc("Recommendation"), "Name"))
