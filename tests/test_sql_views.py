"""The canonical tables as Spark SQL views: a statement written in SQL gets
the operator's answer (Catalyst plans both the same way)."""

from ledgerlens.operators import sales
from ledgerlens.sources import SalesData


def test_sql_statement_matches_operator(spark, sf_small):
    d = SalesData(spark, sf_small)
    names = d.register_views()
    assert "sales_sales_order_detail" in names and len(names) == 15
    via_sql = spark.sql("""
        SELECT year(ModifiedDate) AS Year, quarter(ModifiedDate) AS QUARTER, month(ModifiedDate) AS Month,
               CAST(sum(LineTotal) AS decimal(20,2)) AS TotalRevenue
        FROM sales_sales_order_detail
        GROUP BY year(ModifiedDate), quarter(ModifiedDate), month(ModifiedDate)
        ORDER BY 1, 2, 3""")
    assert via_sql.collect() == sales.revenue_by_period(d.detail()).collect()
