"""Hand-made canonical rows for edge cases (FIXTURES.md §4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

from ledgerlens.sources import schemas


def ts(y, m, d=1):
    return dt.datetime(y, m, d)


def frame(spark, name, rows):
    """A canonical table from tuples (all columns) or dicts (missing -> NULL)."""
    schema = schemas.ALL[name]
    cols = [f.name for f in schema.fields]
    norm = [tuple(r.get(c) for c in cols) if isinstance(r, dict) else tuple(r) for r in rows]
    return spark.createDataFrame(norm, schema)


def header(spark, rows):
    base = dict(TerritoryID=1, ShipToAddressID=1, DueDate=None, ShipDate=None,
                OnlineOrderFlag=False, SubTotal=D("0"), TotalDue=D("0"))
    full = []
    for r in rows:
        x = {**base, **r}
        x.setdefault("ModifiedDate", x.get("OrderDate"))
        x.setdefault("ShipToAddressID", x.get("CustomerID"))
        full.append(x)
    return frame(spark, "header", full)


def detail(spark, rows):
    base = dict(OrderQty=1, UnitPrice=D("0"), UnitPriceDiscount=D("0"), LineTotal=D("0"),
                ModifiedDate=ts(2020, 1))
    return frame(spark, "detail", [{**base, **r} for r in rows])


def product(spark, rows):
    base = dict(ListPrice=D("10"), StandardCost=D("5"), ReorderPoint=0, ProductSubcategoryID="s")
    out = []
    for r in rows:
        x = {**base, **r}
        x.setdefault("Name", f"P{x['ProductID']}")
        out.append(x)
    return frame(spark, "product", out)
