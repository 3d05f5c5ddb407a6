"""Explicit schemas of the canonical tables the operators read.

A user with their own sales database maps it onto these columns (extra
columns are ignored; only the columns an operator uses are read).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LONG, INT, STR, BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()
TS = T.TimestampNTZType()
MONEY2 = T.DecimalType(18, 2)
MONEY4 = T.DecimalType(18, 4)

HEADER = _s(("SalesOrderID", LONG), ("CustomerID", LONG), ("TerritoryID", LONG),
            ("ShipToAddressID", LONG), ("OrderDate", TS), ("DueDate", TS), ("ShipDate", TS),
            ("ModifiedDate", TS), ("OnlineOrderFlag", BOOL), ("SubTotal", MONEY2),
            ("TotalDue", MONEY2))
DETAIL = _s(("SalesOrderID", LONG), ("ProductID", LONG), ("OrderQty", INT),
            ("UnitPrice", T.DecimalType(18, 8)), ("UnitPriceDiscount", T.DecimalType(4, 2)),
            ("LineTotal", MONEY4), ("ModifiedDate", TS))
PRODUCT = _s(("ProductID", LONG), ("Name", STR), ("ListPrice", MONEY2), ("StandardCost", MONEY4),
             ("ReorderPoint", INT), ("ProductSubcategoryID", STR))
SUBCATEGORY = _s(("ProductSubcategoryID", STR), ("ProductCategoryID", STR))
CATEGORY = _s(("ProductCategoryID", STR), ("Name", STR))
INVENTORY = _s(("ProductID", LONG), ("LocationID", LONG), ("Quantity", INT))
LOCATION = _s(("LocationID", LONG), ("Name", STR))
CUSTOMER = _s(("CustomerID", LONG), ("StoreID", LONG), ("PersonID", LONG))
TERRITORY = _s(("TerritoryID", LONG), ("Name", STR), ("SalesYTD", MONEY2))
PO_HEADER = _s(("PurchaseOrderID", STR), ("VendorID", LONG), ("OrderDate", TS), ("ShipDate", TS))
PO_DETAIL = _s(("PurchaseOrderID", STR), ("LineTotal", MONEY4))
VENDOR = _s(("BusinessEntityID", LONG), ("Name", STR))
ADDRESS = _s(("AddressID", LONG), ("City", STR), ("StateProvinceID", LONG))
STATE_PROVINCE = _s(("StateProvinceID", LONG), ("Name", STR), ("CountryRegionCode", STR))
COUNTRY_REGION = _s(("CountryRegionCode", STR), ("Name", STR))

ALL = {
    "header": HEADER, "detail": DETAIL, "product": PRODUCT, "subcategory": SUBCATEGORY,
    "category": CATEGORY, "inventory": INVENTORY, "location": LOCATION, "customer": CUSTOMER,
    "territory": TERRITORY, "po_header": PO_HEADER, "po_detail": PO_DETAIL, "vendor": VENDOR,
    "address": ADDRESS, "state_province": STATE_PROVINCE, "country_region": COUNTRY_REGION,
}
