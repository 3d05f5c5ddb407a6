"""Canonical sales tables derived from the driver's TPC-H-style Parquet files.

The operators read fifteen canonical tables (order header and detail, product
and its category levels, inventory, customers, territories, purchasing and
geography).  The driver data holds none of them directly, so ``SalesData``
derives each one with native DataFrame expressions.  Columns marked
*stand-in* in ``FIXTURES.md`` have no true source and exist so that the
operators can be exercised.  ``ledgerlens.sources.sql_views`` holds the same
derivations as SQL for the DuckDB oracle; the two must stay identical.

Everything is lazy: a DataFrame is only planned when an operator uses it, and
Catalyst prunes the columns an operator does not read down to the Parquet
scan.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (shared with sql_views.py).
ONLINE_PRIORITIES = ("1-URGENT", "2-HIGH")
STORE_SEGMENTS = ("BUILDING", "MACHINERY")
PERSON_SEGMENTS = ("HOUSEHOLD", "FURNITURE")
DUE_DAYS = 30
SALES_YTD_YEAR = 2001
COST_BASE = Decimal("0.40")
COST_PER_SIZE = Decimal("0.06")


def _dec(col: Column | str, precision: int, scale: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(f"decimal({precision},{scale})")


class SalesData:
    """Lazy canonical tables over ``{path}/{table}.parquet``.

    Files are listed when a table is first used by an instance; a new
    instance sees files added since."""

    def __init__(self, spark: SparkSession, path):
        self.spark = spark
        self.path = str(path).rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    # -- sales ---------------------------------------------------------------
    def header(self, territory: bool = False, ship_date: bool = False) -> DataFrame:
        """Sales.SalesOrderHeader, one row per order.

        ``TerritoryID`` (customer's region) and ``ShipDate`` (last line ship
        date) need a join each, so they are only added when asked for.
        """
        o = self.raw("orders")
        price = _dec("o_totalprice", 18, 2)
        df = o.select(
            F.col("o_orderkey").alias("SalesOrderID"),
            F.col("o_custkey").alias("CustomerID"),
            F.col("o_custkey").alias("ShipToAddressID"),
            F.col("o_orderdate").alias("OrderDate"),
            (F.col("o_orderdate") + F.expr(f"INTERVAL {DUE_DAYS} DAYS")).alias("DueDate"),
            F.col("o_orderdate").alias("ModifiedDate"),
            F.col("o_orderpriority").isin(*ONLINE_PRIORITIES).alias("OnlineOrderFlag"),
            price.alias("SubTotal"),
            price.alias("TotalDue"),
        )
        if territory:
            df = df.join(self._customer_region(), "CustomerID", "left")
        if ship_date:
            shipped = (self.raw("lineitem").groupBy("l_orderkey")
                       .agg(F.max("l_shipdate").alias("ShipDate"))
                       .withColumnRenamed("l_orderkey", "SalesOrderID"))
            df = df.join(shipped, "SalesOrderID", "left")
        return df

    def _customer_region(self) -> DataFrame:
        nation = self.raw("nation").select(
            F.col("n_nationkey").alias("c_nationkey"),
            F.col("n_regionkey").cast("long").alias("TerritoryID"))
        return (self.raw("customer")
                .select(F.col("c_custkey").alias("CustomerID"), "c_nationkey")
                .join(nation, "c_nationkey", "left")
                .select("CustomerID", "TerritoryID"))

    def detail(self) -> DataFrame:
        """Sales.SalesOrderDetail, one row per line item."""
        li = self.raw("lineitem")
        price = _dec("l_extendedprice", 18, 2)
        disc = _dec("l_discount", 4, 2)
        qty = F.col("l_quantity").cast("int")
        return li.select(
            F.col("l_orderkey").alias("SalesOrderID"),
            F.col("l_partkey").alias("ProductID"),
            qty.alias("OrderQty"),
            _dec(price / qty, 18, 8).alias("UnitPrice"),
            disc.alias("UnitPriceDiscount"),
            _dec(price * (F.lit(1) - disc), 18, 4).alias("LineTotal"),
            F.col("l_shipdate").alias("ModifiedDate"),
        )

    def customer(self) -> DataFrame:
        c = self.raw("customer")
        seg = F.col("c_mktsegment")
        return c.select(
            F.col("c_custkey").alias("CustomerID"),
            F.when(seg.isin(*STORE_SEGMENTS), F.col("c_nationkey").cast("long")).alias("StoreID"),
            F.when(seg.isin(*PERSON_SEGMENTS), F.col("c_custkey")).alias("PersonID"),
        )

    def territory(self) -> DataFrame:
        """Sales.SalesTerritory: one row per region; SalesYTD is a stand-in."""
        h = self.header(territory=True)
        ytd = (h.filter(F.year("OrderDate") == SALES_YTD_YEAR)
               .groupBy("TerritoryID").agg(F.sum("TotalDue").alias("ytd")))
        r = self.raw("region").select(
            F.col("r_regionkey").cast("long").alias("TerritoryID"),
            F.col("r_name").alias("Name"))
        return (r.join(ytd, "TerritoryID", "left")
                .select("TerritoryID", "Name",
                        _dec(F.coalesce("ytd", F.lit(0)), 18, 2).alias("SalesYTD")))

    # -- products ------------------------------------------------------------
    def product(self) -> DataFrame:
        p = self.raw("part")
        list_price = _dec("p_retailprice", 18, 2)
        factor = F.lit(COST_BASE) + F.lit(COST_PER_SIZE) * F.col("p_size")
        return p.select(
            F.col("p_partkey").alias("ProductID"),
            F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("Name"),
            list_price.alias("ListPrice"),
            _dec(list_price * factor, 18, 4).alias("StandardCost"),
            (F.col("p_size") * 10).alias("ReorderPoint"),
            F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("ProductSubcategoryID"),
        )

    def subcategory(self) -> DataFrame:
        return (self.raw("part")
                .select(F.concat(F.col("p_type"), F.lit("/"), F.col("p_brand")).alias("ProductSubcategoryID"),
                        F.col("p_type").alias("ProductCategoryID"))
                .distinct())

    def category(self) -> DataFrame:
        return (self.raw("part")
                .select(F.col("p_type").alias("ProductCategoryID"), F.col("p_type").alias("Name"))
                .distinct())

    def inventory(self) -> DataFrame:
        """Production.ProductInventory: returned stock per (part, supplier) (stand-in)."""
        li = self.raw("lineitem")
        returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))
        return (li.groupBy("l_partkey", "l_suppkey")
                .agg(F.sum(returned).cast("int").alias("Quantity"))
                .select(F.col("l_partkey").alias("ProductID"),
                        F.col("l_suppkey").alias("LocationID"),
                        "Quantity"))

    def location(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("LocationID"),
                                           F.col("s_name").alias("Name"))

    # -- purchasing ----------------------------------------------------------
    def _po_key(self) -> Column:
        # text of both parts: no two (order, supplier) pairs share it, however large the keys
        return F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_suppkey").cast("string"))

    def po_header(self, line_total: bool = False) -> DataFrame:
        """Purchasing.PurchaseOrderHeader; ``line_total`` adds each order's sum of
        line totals (``LineTotal``) in the same fold of the lines."""
        li = self.raw("lineitem")
        o = self.raw("orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                      F.col("o_orderdate").alias("OrderDate"))
        po = (li.groupBy("l_orderkey", "l_suppkey")
              .agg(F.max("l_shipdate").alias("ShipDate"), F.sum(self._po_line()).alias("LineTotal")))
        return (po.join(o, "l_orderkey")
                .select(self._po_key().alias("PurchaseOrderID"),
                        F.col("l_suppkey").alias("VendorID"),
                        "OrderDate", "ShipDate", *(["LineTotal"] if line_total else [])))

    def _po_line(self) -> Column:
        return _dec("l_extendedprice", 18, 2).cast("decimal(18,4)")

    def po_detail(self) -> DataFrame:
        return self.raw("lineitem").select(
            self._po_key().alias("PurchaseOrderID"),
            self._po_line().alias("LineTotal"))

    def vendor(self) -> DataFrame:
        return self.raw("supplier").select(F.col("s_suppkey").alias("BusinessEntityID"),
                                           F.col("s_name").alias("Name"))

    # -- geography -----------------------------------------------------------
    def address(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("AddressID"),
            F.col("c_mktsegment").alias("City"),
            F.col("c_nationkey").cast("long").alias("StateProvinceID"))

    def state_province(self) -> DataFrame:
        return self.raw("nation").select(
            F.col("n_nationkey").cast("long").alias("StateProvinceID"),
            F.col("n_name").alias("Name"),
            F.col("n_regionkey").cast("string").alias("CountryRegionCode"))

    def country_region(self) -> DataFrame:
        return self.raw("region").select(
            F.col("r_regionkey").cast("string").alias("CountryRegionCode"),
            F.col("r_name").alias("Name"))

    # -- SQL access ------------------------------------------------------------
    VIEW_NAMES = {
        "sales_order_header": lambda d: d.header(territory=True, ship_date=True),
        "sales_order_detail": lambda d: d.detail(),
        "customer": lambda d: d.customer(),
        "sales_territory": lambda d: d.territory(),
        "product": lambda d: d.product(),
        "product_subcategory": lambda d: d.subcategory(),
        "product_category": lambda d: d.category(),
        "product_inventory": lambda d: d.inventory(),
        "location": lambda d: d.location(),
        "purchase_order_header": lambda d: d.po_header(),
        "purchase_order_detail": lambda d: d.po_detail(),
        "vendor": lambda d: d.vendor(),
        "address": lambda d: d.address(),
        "state_province": lambda d: d.state_province(),
        "country_region": lambda d: d.country_region(),
    }

    def register_views(self, database: str = "sales") -> list[str]:
        """Expose the canonical tables to Spark SQL as temporary views
        ``{database}_{table}`` (e.g. ``sales_sales_order_detail``), the
        counterpart of selecting the database with ``use``.  Views are lazy:
        a statement reads only the tables and columns it mentions."""
        names = []
        for table, build in self.VIEW_NAMES.items():
            name = f"{database}_{table}" if database else table
            build(self).createOrReplaceTempView(name)
            names.append(name)
        return names
