"""File 04: operations and supply chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import money, pct


def _days(po_header: DataFrame) -> DataFrame:
    return po_header.withColumn("_days", F.datediff(F.col("ShipDate"), F.col("OrderDate")))


def avg_fulfillment_days(po_header: DataFrame) -> DataFrame:
    """04.1 Integer mean days from purchase order to shipment."""
    return (_days(po_header).where(F.col("ShipDate").isNotNull())
            .agg(F.expr("sum(_days) div nullif(count(_days), 0)").alias("AVG_FulfillmentTime")))


def vendor_delivery_days(po_header: DataFrame, vendor: DataFrame) -> DataFrame:
    """04.2 Integer mean delivery days per vendor, longest first."""
    per_vendor = (_days(po_header).groupBy("VendorID")
                  .agg(F.expr("sum(_days) div nullif(count(_days), 0)").alias("DeliveryTime")))
    v = vendor.select(F.col("BusinessEntityID").alias("VendorID"), F.col("Name").alias("VendorName"))
    return (per_vendor.join(v, "VendorID")
            .select("VendorID", "VendorName", "DeliveryTime")
            .orderBy(F.desc("DeliveryTime"), F.asc("VendorID")))


def late_shipments(header: DataFrame, strict: bool = False) -> DataFrame:
    """04.3 Orders shipped on or after the due date (after it with
    ``strict=True``), as a count and a percentage of all orders."""
    late_cond = (F.col("ShipDate") > F.col("DueDate")) if strict else (F.col("ShipDate") >= F.col("DueDate"))
    late = F.sum(F.when(late_cond, 1).otherwise(0))
    return header.agg(late.cast("long").alias("NoLateShipment"),
                      pct(late, F.count(F.lit(1)), num_scale=0, den_scale=0)
                      .alias("LateShipmentsRatePercent"))


def inventory_value_by_location(inventory: DataFrame, product: DataFrame,
                                location: DataFrame) -> DataFrame:
    """04.4 Stock value at standard cost per location."""
    value = (inventory.join(product.select("ProductID", "StandardCost"), "ProductID", "left")
             .groupBy("LocationID")
             .agg(money(F.sum(F.col("StandardCost") * F.col("Quantity"))).alias("COGS")))
    loc = location.select("LocationID", F.col("Name").alias("LocationName"))
    return (value.join(loc, "LocationID", "left")
            .select("LocationID", "LocationName", "COGS")
            .orderBy(F.desc("COGS"), "LocationID"))


def purchase_cost_trend(po_header: DataFrame, po_detail: DataFrame | None, vendor: DataFrame) -> DataFrame:
    """04.5 Purchase order line totals per vendor and order year.

    A header that carries its order's ``LineTotal`` needs no ``po_detail``:
    the lines are then neither grouped nor joined by order again."""
    if po_detail is None:
        per_po = po_header.withColumnRenamed("LineTotal", "_lt")
    else:
        per_po = po_header.select("PurchaseOrderID", "VendorID", "OrderDate").join(
            po_detail.groupBy("PurchaseOrderID").agg(F.sum("LineTotal").alias("_lt")), "PurchaseOrderID")
    per_year = (per_po.groupBy("VendorID", F.year("OrderDate").alias("Years"))
                .agg(money(F.sum("_lt")).alias("PurchasingCost")))
    v = vendor.select(F.col("BusinessEntityID").alias("VendorID"), F.col("Name").alias("VendorName"))
    return (per_year.join(v, "VendorID")
            .select("VendorID", "VendorName", "Years", "PurchasingCost")
            .orderBy("VendorID", "Years"))
