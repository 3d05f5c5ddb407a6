"""Sources: files that grow, keys that cannot collide, tables of a catalog."""

import datetime as dt
from decimal import Decimal as D

import pytest

from checks import compare, duckdb_connection
from ledgerlens.operators import operations, profit
from ledgerlens.plans.oracle import ORACLE_SQL
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources import SalesData, TableData


def test_a_new_instance_sees_appended_files(spark, tmp_path):
    path = str(tmp_path / "orders.parquet")
    spark.range(10).write.parquet(path)
    assert SalesData(spark, tmp_path).raw("orders").count() == 10
    spark.range(20).write.mode("append").parquet(path)
    assert SalesData(spark, tmp_path).raw("orders").count() == 30


def test_purchase_orders_of_large_supplier_keys_stay_apart(spark, tmp_path):
    day = dt.datetime(2000, 1, 1)
    line = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, " \
           "l_returnflag string, l_shipdate timestamp_ntz"
    spark.createDataFrame([(1, 1, 100_001, 1.0, 1.0, 0.0, "N", day), (2, 1, 1, 1.0, 1.0, 0.0, "N", day)], line) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, day), (2, day)], "o_orderkey long, o_orderdate timestamp_ntz") \
        .write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, "a"), (100_001, "b")], "s_suppkey long, s_name string") \
        .write.parquet(str(tmp_path / "supplier.parquet"))
    d = SalesData(spark, tmp_path)
    got = {r.VendorID: r.PurchasingCost for r in
           operations.purchase_cost_trend(d.po_header(), d.po_detail(), d.vendor()).collect()}
    assert got == {1: D("1.00"), 100_001: D("1.00")}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_discounted_prices_may_sum_high(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        n = 20_000
        lines = spark.range(n).selectExpr("1L as SalesOrderID", "1L as ProductID", "cast('7500000000' as decimal(18,8)) as UnitPrice",
                                          "cast('0.00' as decimal(4,2)) as UnitPriceDiscount")
        header = spark.createDataFrame([(1,)], "SalesOrderID long")
        product = spark.createDataFrame([(1, "p", D("3750000000.0000"))], "ProductID long, Name string, StandardCost decimal(18,4)")
        row = profit.discount_margin_effect(lines, header, product, fractional_discount=True).first()
        assert row.MarginRateWithDiscount == D("50.00") and row.AvgDiscountedPrice == D("7500000000.0000")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


@pytest.fixture(scope="module")
def catalog(spark, sf_small):
    d = SalesData(spark, sf_small)
    return {name.removeprefix("up_"): name for name in d.register_views("up")}


NAMES = {"header": "sales_order_header", "detail": "sales_order_detail", "territory": "sales_territory",
         "subcategory": "product_subcategory", "category": "product_category", "inventory": "product_inventory",
         "po_header": "purchase_order_header", "po_detail": "purchase_order_detail"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_over_named_tables(spark, sf_small, catalog, name):
    keys = {k: catalog[NAMES.get(k, k)] for k in
            ("header", "detail", "product", "subcategory", "category", "inventory", "location", "customer", "territory",
             "po_header", "po_detail", "vendor", "address", "state_province", "country_region")}
    source = TableData(spark, keys)
    assert compare(QUERIES[name](spark, source), duckdb_connection(sf_small), ORACLE_SQL[name])["match"]


def test_tables_are_checked(spark):
    spark.createDataFrame([(1, 2)], "LocationID long, Name int").createOrReplaceTempView("bad_location")
    spark.createDataFrame([(1,)], "LocationID long").createOrReplaceTempView("short_location")
    with pytest.raises(ValueError, match="Name is int"):
        TableData(spark, {"location": "bad_location"}).location()
    with pytest.raises(ValueError, match="Name is missing"):
        TableData(spark, {"location": "short_location"}).location()
    with pytest.raises(ValueError, match="unknown tables"):
        TableData(spark, {"places": "x"})
