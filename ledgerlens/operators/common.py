"""Shared building blocks: fact totals folded to the grain an operator needs
before any dimension join, so joins see one row per product / order /
customer instead of one per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def product_totals(detail: DataFrame, *extra_keys) -> DataFrame:
    """Per product (and ``extra_keys``): revenue, units, lines, and revenue of
    positive lines only (the margin divisor of file 05)."""
    lt = F.col("LineTotal")
    return (detail.groupBy("ProductID", *extra_keys)
            .agg(F.sum(lt).alias("rev"),
                 F.sum("OrderQty").alias("qty"),
                 F.count(F.lit(1)).alias("lines"),
                 F.sum(F.when(lt > 0, lt)).alias("pos_rev")))


def with_cogs(totals: DataFrame, product: DataFrame, *cols: str) -> DataFrame:
    """Join product cost; COGS = StandardCost * units.  Exact: the cost is
    constant per product, so sum(cost * qty) = cost * sum(qty)."""
    p = product.select("ProductID", "StandardCost", *cols)
    return (totals.join(p, "ProductID")
            .withColumn("cogs", F.col("StandardCost") * F.col("qty")))


def product_category(product: DataFrame, subcategory: DataFrame, category: DataFrame) -> DataFrame:
    """ProductID, ProductName, StandardCost, CategoryName through the
    product -> subcategory -> category snowflake (inner joins: products
    without a subcategory drop out)."""
    sub = subcategory.select("ProductSubcategoryID", "ProductCategoryID")
    cat = category.select("ProductCategoryID", F.col("Name").alias("CategoryName"))
    return (product.select("ProductID", F.col("Name").alias("ProductName"), "StandardCost",
                           "ProductSubcategoryID")
            .join(sub, "ProductSubcategoryID")
            .join(cat, "ProductCategoryID")
            .select("ProductID", "ProductName", "StandardCost", "CategoryName"))


def order_line_totals(detail: DataFrame, product: DataFrame | None = None) -> DataFrame:
    """Per order: line count, units, revenue and (with ``product``) COGS."""
    lines = detail
    aggs = [F.count(F.lit(1)).alias("lines"), F.sum("OrderQty").alias("qty"),
            F.sum("LineTotal").alias("rev")]
    if product is not None:
        lines = detail.join(product.select("ProductID", "StandardCost"), "ProductID")
        aggs.append(F.sum(F.col("StandardCost") * F.col("OrderQty")).alias("cogs"))
    return lines.groupBy("SalesOrderID").agg(*aggs)


def existing_customers(customer: DataFrame) -> DataFrame:
    return customer.select("CustomerID")


def customer_line_value(header: DataFrame, customer: DataFrame, detail: DataFrame) -> DataFrame:
    """ID, LSV: lifetime line value per customer.  Lines are summed per order,
    then per customer, before the existence check against Customer."""
    per_order = detail.groupBy("SalesOrderID").agg(F.sum("LineTotal").alias("lt"))
    per_cust = (header.select("SalesOrderID", "CustomerID").join(per_order, "SalesOrderID")
                .groupBy("CustomerID").agg(F.sum("lt").alias("LSV")))
    return (per_cust.join(existing_customers(customer), "CustomerID", "left_semi")
            .select(F.col("CustomerID").alias("ID"), "LSV"))


def customer_subtotal(header: DataFrame, customer: DataFrame) -> DataFrame:
    """CustomerID, Revenue (sum of SubTotal), Orders (distinct) for customers
    that exist in Customer."""
    per_cust = header.groupBy("CustomerID").agg(
        F.sum("SubTotal").alias("Revenue"),
        F.count_distinct("SalesOrderID").alias("Orders"))
    return per_cust.join(existing_customers(customer), "CustomerID", "left_semi")
