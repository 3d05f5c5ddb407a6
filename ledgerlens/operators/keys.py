"""Key profile: what the joins of the operators rely on, measured.

An existence join (``left_semi``) gives the original inner join's answer only
where the right key is unique; inner joins drop lines without a partner.
``key_profile`` checks every declared key of the canonical tables: one
aggregate by the key counts rows, distinct keys, rows beyond the first of a
key and null keys, and for a reference the rows whose key the other table
lacks.  A key is one row after map-side aggregation, so a hot key is cheap.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The keys of the canonical tables, unique ones and references.
UNIQUE = (
    ("header", ("SalesOrderID",)),
    ("product", ("ProductID",)),
    ("subcategory", ("ProductSubcategoryID",)),
    ("category", ("ProductCategoryID",)),
    ("inventory", ("ProductID", "LocationID")),
    ("location", ("LocationID",)),
    ("customer", ("CustomerID",)),
    ("territory", ("TerritoryID",)),
    ("po_header", ("PurchaseOrderID",)),
    ("vendor", ("BusinessEntityID",)),
    ("address", ("AddressID",)),
    ("state_province", ("StateProvinceID",)),
    ("country_region", ("CountryRegionCode",)),
)
REFERENCES = (
    ("detail", "SalesOrderID", "header", "SalesOrderID"),
    ("detail", "ProductID", "product", "ProductID"),
    ("header", "CustomerID", "customer", "CustomerID"),
    ("header", "TerritoryID", "territory", "TerritoryID"),
    ("header", "ShipToAddressID", "address", "AddressID"),
    ("product", "ProductSubcategoryID", "subcategory", "ProductSubcategoryID"),
    ("subcategory", "ProductCategoryID", "category", "ProductCategoryID"),
    ("inventory", "ProductID", "product", "ProductID"),
    ("inventory", "LocationID", "location", "LocationID"),
    ("po_header", "VendorID", "vendor", "BusinessEntityID"),
    ("po_detail", "PurchaseOrderID", "po_header", "PurchaseOrderID"),
    ("address", "StateProvinceID", "state_province", "StateProvinceID"),
    ("state_province", "CountryRegionCode", "country_region", "CountryRegionCode"),
)


def _by_key(df: DataFrame, columns) -> DataFrame:
    key = F.struct(*columns)
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.groupBy(F.when(~null, key).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def _summary(table: str, columns, reference: str, keys: DataFrame, orphan) -> DataFrame:
    known = F.col("key").isNotNull()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return keys.agg(
        F.lit(table).alias("TableName"), F.lit(", ".join(columns)).alias("KeyColumns"), F.lit(reference).alias("RefersTo"),
        total("n").alias("RowsTotal"), F.count("key").alias("DistinctKeys"), total(F.when(known, F.col("n") - 1)).alias("RepeatedRows"),
        total(F.when(~known, F.col("n"))).alias("NullRows"), total(F.when(known & orphan, F.col("n"))).alias("OrphanRows"))


def key_profile(source, unique=UNIQUE, references=REFERENCES) -> DataFrame:
    """One row per declared key of ``source`` (any source of canonical tables)."""
    def table(name):
        return source.header(territory=True) if name == "header" else getattr(source, name)()

    parts = [_summary(t, columns, "", _by_key(table(t), columns), F.lit(False)) for t, columns in unique]
    for t, column, other, target in references:
        keys = _by_key(table(t).select(F.col(column).alias("k")), ["k"])
        held = _by_key(table(other).select(F.col(target).alias("k")), ["k"]).select(F.col("key").alias("held"))
        joined = keys.join(held, F.col("key") == F.col("held"), "left")
        parts.append(_summary(t, [column], f"{other}.{target}", joined, F.col("held").isNull()))
    return reduce(DataFrame.unionByName, parts)
