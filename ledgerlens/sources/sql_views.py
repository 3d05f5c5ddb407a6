"""The canonical tables of ``adapter.py`` as SQL common table expressions.

Used by the DuckDB oracle (``ledgerlens.plans.oracle``), whose raw tables are
pre-registered views named after the driver files.  Each derivation must match
``SalesData`` expression for expression.
"""

from __future__ import annotations

from .adapter import (COST_BASE, COST_PER_SIZE, DUE_DAYS, ONLINE_PRIORITIES,
                      PERSON_SEGMENTS, SALES_YTD_YEAR, STORE_SEGMENTS)


def _in(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


VIEWS: dict[str, str] = {
    "so_header": f"""
        SELECT o.o_orderkey AS SalesOrderID, o.o_custkey AS CustomerID,
               CAST(n.n_regionkey AS BIGINT) AS TerritoryID,
               o.o_custkey AS ShipToAddressID, o.o_orderdate AS OrderDate,
               o.o_orderdate + INTERVAL {DUE_DAYS} DAY AS DueDate,
               s.ShipDate, o.o_orderdate AS ModifiedDate,
               o.o_orderpriority IN ({_in(ONLINE_PRIORITIES)}) AS OnlineOrderFlag,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS SubTotal,
               CAST(o.o_totalprice AS DECIMAL(18,2)) AS TotalDue
        FROM orders o
        LEFT JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS ShipDate
                   FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey""",
    "so_detail": """
        SELECT l_orderkey AS SalesOrderID, l_partkey AS ProductID,
               CAST(l_quantity AS INTEGER) AS OrderQty,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) / CAST(l_quantity AS INTEGER)
                    AS DECIMAL(18,8)) AS UnitPrice,
               CAST(l_discount AS DECIMAL(4,2)) AS UnitPriceDiscount,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                    * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS LineTotal,
               l_shipdate AS ModifiedDate
        FROM lineitem""",
    "cust": f"""
        SELECT c_custkey AS CustomerID,
               CASE WHEN c_mktsegment IN ({_in(STORE_SEGMENTS)})
                    THEN CAST(c_nationkey AS BIGINT) END AS StoreID,
               CASE WHEN c_mktsegment IN ({_in(PERSON_SEGMENTS)})
                    THEN c_custkey END AS PersonID
        FROM customer""",
    "territory": f"""
        SELECT CAST(r.r_regionkey AS BIGINT) AS TerritoryID, r.r_name AS Name,
               CAST(COALESCE(y.ytd, 0) AS DECIMAL(18,2)) AS SalesYTD
        FROM region r
        LEFT JOIN (SELECT TerritoryID, sum(TotalDue) AS ytd FROM so_header
                   WHERE year(OrderDate) = {SALES_YTD_YEAR} GROUP BY TerritoryID) y
          ON y.TerritoryID = CAST(r.r_regionkey AS BIGINT)""",
    "prod": f"""
        SELECT p_partkey AS ProductID,
               p_name || ' #' || CAST(p_partkey AS VARCHAR) AS Name,
               CAST(p_retailprice AS DECIMAL(18,2)) AS ListPrice,
               CAST(CAST(p_retailprice AS DECIMAL(18,2))
                    * ({COST_BASE} + {COST_PER_SIZE} * p_size) AS DECIMAL(18,4)) AS StandardCost,
               p_size * 10 AS ReorderPoint,
               p_type || '/' || p_brand AS ProductSubcategoryID
        FROM part""",
    "prod_subcat": """
        SELECT DISTINCT p_type || '/' || p_brand AS ProductSubcategoryID,
               p_type AS ProductCategoryID
        FROM part""",
    "prod_cat": """
        SELECT DISTINCT p_type AS ProductCategoryID, p_type AS Name FROM part""",
    "prod_inv": """
        SELECT l_partkey AS ProductID, l_suppkey AS LocationID,
               CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END)
                    AS INTEGER) AS Quantity
        FROM lineitem GROUP BY l_partkey, l_suppkey""",
    "inv_location": """
        SELECT s_suppkey AS LocationID, s_name AS Name FROM supplier""",
    "po_header": f"""
        SELECT concat(l.l_orderkey, '/', l.l_suppkey) AS PurchaseOrderID,
               l.l_suppkey AS VendorID, o.o_orderdate AS OrderDate,
               max(l.l_shipdate) AS ShipDate
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        GROUP BY l.l_orderkey, l.l_suppkey, o.o_orderdate""",
    "po_detail": f"""
        SELECT concat(l_orderkey, '/', l_suppkey) AS PurchaseOrderID,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS LineTotal
        FROM lineitem""",
    "vendor": """
        SELECT s_suppkey AS BusinessEntityID, s_name AS Name FROM supplier""",
    "address": """
        SELECT c_custkey AS AddressID, c_mktsegment AS City,
               CAST(c_nationkey AS BIGINT) AS StateProvinceID
        FROM customer""",
    "state_province": """
        SELECT CAST(n_nationkey AS BIGINT) AS StateProvinceID, n_name AS Name,
               CAST(n_regionkey AS VARCHAR) AS CountryRegionCode
        FROM nation""",
    "country_region": """
        SELECT CAST(r_regionkey AS VARCHAR) AS CountryRegionCode, r_name AS Name
        FROM region""",
}

# Views that read other canonical views.
_DEPENDS = {"territory": ("so_header",)}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the canonical views it mentions, as CTEs."""
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in _DEPENDS.get(name, ()):
            add(dep)
        if name not in needed:
            needed.append(name)

    lowered = sql.lower()
    for name in VIEWS:
        if _mentions(lowered, name):
            add(name)
    if not needed:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _mentions(sql: str, name: str) -> bool:
    import re
    return re.search(rf"(?<![a-z0-9_]){name}(?![a-z0-9_])", sql) is not None
