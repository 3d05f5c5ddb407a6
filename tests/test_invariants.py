"""Invariants of SURVEY §5.2 on the driver data."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import advanced, customers, products, sales
from ledgerlens.sources import SalesData


@pytest.fixture(scope="module")
def data(spark, sf_small):
    return SalesData(spark, sf_small)


def test_pareto_share_is_monotone_and_reaches_100(data):
    full = advanced.pareto_products(data.detail(), data.product(), cutoff="1").collect()
    shares = [r.CummulativeRevenuePercent for r in full]
    assert shares == sorted(shares)
    assert shares[-1] == D("100.00")
    cut = advanced.pareto_products(data.detail(), data.product()).collect()
    assert all(r.CummulativeRevenuePercent <= D("80.00") for r in cut)
    assert len(cut) < len(full)


def test_revenue_by_period_sums_to_total(data):
    parts = sum(r.TotalRevenue for r in sales.revenue_by_period(data.detail()).collect())
    total = data.detail().agg(F.sum("LineTotal")).first()[0]
    # each period is rounded to cents: the sum is within half a cent per period
    n = sales.revenue_by_period(data.detail()).count()
    assert abs(parts - total) <= D("0.005") * n


def test_pair_total_equals_line_self_join(data):
    d = data.detail()
    pairs = products.products_bought_together(d, data.product())
    total = pairs.agg(F.sum("No_PurchasedTogether")).first()[0]
    a, b = d.alias("a"), d.alias("b")
    brute = a.join(b, (F.col("a.SalesOrderID") == F.col("b.SalesOrderID"))
                   & (F.col("a.ProductID") > F.col("b.ProductID"))).count()
    assert total == brute


def test_clv_equals_mean_revenue_per_customer(data):
    clv = {r.Segments: r.AOV_CLV_Segments for r in customers.clv_by_segment(data.header(), data.customer()).collect()}
    seg = (data.header().groupBy("CustomerID").agg(F.sum("TotalDue").alias("rev"))
           .join(data.customer().select("CustomerID", F.when(F.col("StoreID").isNotNull(), "Store")
                                        .when(F.col("PersonID").isNotNull(), "Individual")
                                        .otherwise("Unknown").alias("Segments")), "CustomerID")
           .groupBy("Segments").agg(F.avg("rev").alias("m")))
    for r in seg.collect():
        assert abs(clv[r.Segments] - r.m) <= D("0.01")


def test_ntile_groups_partition_all_customers(data):
    rfm = advanced.rfm(data.customer(), data.header(), "2001-08-01")
    n = rfm.count()
    sizes = [r["count"] for r in rfm.groupBy(F.substring("RFM", 1, 1)).count().collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
