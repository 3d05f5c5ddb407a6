"""Statements with parameters as SQL table functions of the session.

``register`` defines, over a source of canonical tables, functions that SQL
users call with the literals they would otherwise edit in the statement:

    SELECT * FROM sales_lapsed_customers(as_of => DATE'2001-08-01', months => 6)
    SELECT * FROM sales_rfm(DATE'2001-08-01') WHERE RFM LIKE '55%'

They are temporary SQL functions over temporary views, so Catalyst plans the
body with the caller's statement and filters and columns reach the scans.
Parameters default to the operators' defaults (``fixed.py``); ``as_of`` has
none.  The tiles of 07.5 and 07.6 need a total order: they are found by
counting (``operators.selection``) when the functions are registered and kept
as comparisons in a view.  They do not depend on ``as_of``, which moves every
customer's recency by the same number of days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import fixed as V
from ..operators.advanced import rfm_scores
from ..sources.adapter import SalesData

_ANY_DAY = dt.date(2000, 1, 1)

#: Result columns, parameters and body of each function; {p} is the prefix of
#: the views and functions, {V} the fixed values.
FUNCTIONS = {
    "lapsed_customers": (
        "as_of DATE, months INT DEFAULT {V.LAPSE_MONTHS}",
        "CustomerID BIGINT, DATE TIMESTAMP_NTZ",
        """SELECT c.CustomerID, o.last_order
           FROM (SELECT DISTINCT CustomerID FROM {p}customer) c
           LEFT JOIN (SELECT CustomerID, max(OrderDate) AS last_order FROM {p}sales_order_header GROUP BY CustomerID) o
             ON o.CustomerID = c.CustomerID
           WHERE o.last_order IS NULL OR o.last_order < CAST(as_of AS TIMESTAMP_NTZ) - make_ym_interval(0, months)"""),
    "rfm": (
        "as_of DATE",
        "CustomerID BIGINT, Recency INT, Frequency BIGINT, Monetary DECIMAL(38,4), RFM STRING",
        """SELECT CustomerID, datediff(as_of, LastDay), Frequency, CAST(Monetary AS DECIMAL(38,4)), RFM FROM {p}customer_tiles"""),
    "churn_risk": (
        "as_of DATE, r_score INT DEFAULT {V.CHURN_R_SCORE}",
        "CustomerID BIGINT, Recency INT, Frequency BIGINT, Monetary DECIMAL(38,4), RFM STRING",
        """SELECT CustomerID, datediff(as_of, LastDay), Frequency, CAST(Monetary AS DECIMAL(38,4)), RFM FROM {p}customer_tiles
           WHERE R_score = {p}churn_risk.r_score"""),
    "overstocked_low_sellers": (
        "max_orders BIGINT DEFAULT {V.LOW_SELLER_MAX_UNITS}",
        "ProductID BIGINT, Name STRING, Orders BIGINT, iQty BIGINT",
        """WITH stock AS (SELECT ProductID, sum(Quantity) AS q, count(*) AS places FROM {p}product_inventory GROUP BY ProductID),
                sold AS (SELECT ProductID, sum(OrderQty) AS units FROM {p}sales_order_detail GROUP BY ProductID)
           SELECT p.ProductID, p.Name, units, q FROM sold JOIN stock USING (ProductID) JOIN {p}product p USING (ProductID)
           WHERE units < max_orders AND q > (SELECT sum(q) DIV sum(places) FROM stock)"""),
    "high_revenue_low_profit_territories": (
        "min_revenue DECIMAL(38,4) DEFAULT {V.HIGH_REVENUE_MIN}, max_profit DECIMAL(38,4) DEFAULT {V.LOW_PROFIT_MAX}",
        "TerritoryID BIGINT, Revenue DECIMAL(20,2), COGS DECIMAL(20,2), Profit DECIMAL(20,2)",
        """WITH folded AS (
             SELECT TerritoryID, ProductID, sum(LineTotal) AS rev, sum(OrderQty) AS units
             FROM {p}sales_order_detail JOIN {p}sales_order_header USING (SalesOrderID) GROUP BY TerritoryID, ProductID),
           total AS (
             SELECT TerritoryID, sum(rev) AS r, sum(StandardCost * units) AS c FROM folded JOIN {p}product USING (ProductID)
             GROUP BY TerritoryID)
           SELECT TerritoryID, CAST(r AS DECIMAL(20,2)), CAST(c AS DECIMAL(20,2)), CAST(r - c AS DECIMAL(20,2)) FROM total
           WHERE r > min_revenue AND r - c < max_profit"""),
    "product_recommendation": (
        "discontinue_units BIGINT DEFAULT {V.DISCONTINUE_MAX_UNITS}, discontinue_profit DECIMAL(38,4) DEFAULT {V.DISCONTINUE_MAX_PROFIT}, "
        "promote_units BIGINT DEFAULT {V.PROMOTE_MIN_UNITS}, promote_profit DECIMAL(38,4) DEFAULT {V.PROMOTE_MIN_PROFIT}",
        "Name STRING, UnitSold BIGINT, Profit DECIMAL(38,4), Recommendation STRING",
        """WITH sold AS (SELECT ProductID, sum(OrderQty) AS units, sum(LineTotal) AS rev FROM {p}sales_order_detail GROUP BY ProductID),
                named AS (
             SELECT Name, sum(units) AS units, sum(rev) AS rev, sum(rev) - sum(StandardCost * units) AS gain
             FROM {p}product LEFT JOIN sold USING (ProductID) GROUP BY Name)
           SELECT Name, coalesce(units, 0), CAST(coalesce(gain, 0) AS DECIMAL(38,4)),
             CASE WHEN rev IS NULL OR units < discontinue_units AND gain < discontinue_profit THEN '{V.RECOMMEND_DISCONTINUE}'
                  WHEN units > promote_units AND gain > promote_profit THEN '{V.RECOMMEND_PROMOTE}'
                  ELSE '{V.RECOMMEND_MONITOR}' END
           FROM named"""),
}


def register(source, database: str = "sales", tiles: int = V.TILES) -> list[str]:
    """Register the canonical views and the functions as ``{database}_{name}``
    in the session; the functions' names."""
    spark = source.spark
    prefix = f"{database}_" if database else ""
    SalesData.register_views(source, database)
    scores = rfm_scores(source.customer(), source.header(), _ANY_DAY, tiles)
    (scores.withColumn("LastDay", F.date_sub(F.lit(_ANY_DAY), F.col("Recency"))).drop("Recency")
     .createOrReplaceTempView(f"{prefix}customer_tiles"))
    for name, (parameters, columns, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters.format(V=V)}) RETURNS TABLE ({columns}) "
                  f"RETURN {body.format(p=prefix, V=V)}")
    return [prefix + name for name in FUNCTIONS]
