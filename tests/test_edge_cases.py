"""Hand-computed answers for edge cases the driver data lacks (FIXTURES.md §4)."""

import datetime as dt
from decimal import Decimal as D

from fixtures import detail, frame, header, product, ts

from ledgerlens.operators import (advanced, customers, executive, geo, operations, products, profit,
                                  sales)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# -- 02 customers --------------------------------------------------------------

def test_lapsed_includes_never_ordered(spark):
    cust = frame(spark, "customer", [(1, None, 1), (2, None, 2), (3, None, 3)])
    h = header(spark, [dict(SalesOrderID=10, CustomerID=1, OrderDate=ts(2000, 1)),
                       dict(SalesOrderID=11, CustomerID=2, OrderDate=ts(2001, 6))])
    got = rows(customers.lapsed_customers(cust, h, dt.date(2001, 8, 1)), "CustomerID", "DATE")
    assert got == [(1, ts(2000, 1)), (3, None)]


def test_segments_store_wins_and_clv_zero_day_lifetime(spark):
    cust = frame(spark, "customer", [(1, 5, 1), (2, None, 2), (3, None, None)])
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 1), TotalDue=D("100")),
                       dict(SalesOrderID=2, CustomerID=1, OrderDate=ts(2000, 1), TotalDue=D("50")),
                       dict(SalesOrderID=3, CustomerID=2, OrderDate=ts(2000, 1), TotalDue=D("30")),
                       dict(SalesOrderID=4, CustomerID=2, OrderDate=ts(2000, 7), TotalDue=D("10")),
                       dict(SalesOrderID=5, CustomerID=3, OrderDate=ts(2000, 3), TotalDue=D("7"))])
    seg = dict(rows(customers.revenue_by_segment(h, cust), "Segments", "Revenue"))
    assert seg == {"Store": D("150"), "Individual": D("40"), "Unknown": D("7")}
    clv = dict(rows(customers.clv_by_segment(h, cust), "Segments", "AOV_CLV_Segments"))
    # AOV * lifetime * orders / lifetime = revenue per customer
    assert clv == {"Store": D("150.00"), "Individual": D("40.00"), "Unknown": D("7.00")}


def test_retention_skipped_year(spark):
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 1)),
                       dict(SalesOrderID=2, CustomerID=1, OrderDate=ts(2002, 1)),
                       dict(SalesOrderID=3, CustomerID=2, OrderDate=ts(2000, 5)),
                       dict(SalesOrderID=4, CustomerID=2, OrderDate=ts(2001, 5))])
    got = rows(customers.yearly_retention(h), "PrevYears", "LastYearCustomers", "RetainedCustomers",
               "RetentionRate")
    assert got == [(2000, 2, 1, D("50.00")), (2001, 1, 0, D("0.00")), (2002, 1, 0, D("0.00"))]


def test_streaks_literal_and_distinct_months(spark):
    # customer 1: Nov, Dec (2 orders), Jan, Feb -> a second order in a month
    # opens a new island; customer 2: Jan, Mar (gap).
    dates = [(1, ts(2000, 11)), (1, ts(2000, 12, 3)), (1, ts(2000, 12, 20)), (1, ts(2001, 1)),
             (1, ts(2001, 2)), (2, ts(2001, 1)), (2, ts(2001, 3))]
    h = header(spark, [dict(SalesOrderID=i, CustomerID=c, OrderDate=d) for i, (c, d) in enumerate(dates)])
    literal = rows(customers.consecutive_month_streaks(h, 1), "CustomerID", "MaxConsecutiveMonths")
    # islands of customer 1: {Nov, Dec(1st)} counted with its Dec peers -> RANGE frame
    # gives both December orders the same island id: Nov | Dec,Dec,Jan,Feb
    assert literal == [(1, 4), (2, 1)]
    distinct = rows(customers.consecutive_month_streaks(h, 1, distinct_months=True),
                    "CustomerID", "MaxConsecutiveMonths")
    assert distinct == [(1, 4), (2, 1)]
    assert rows(customers.consecutive_month_streaks(h, 5), "CustomerID") == []


# -- 03 products --------------------------------------------------------------

def test_margin_null_for_zero_price_sorted_last(spark):
    p = product(spark, [dict(ProductID=1, ListPrice=D("0"), StandardCost=D("1")),
                        dict(ProductID=2, ListPrice=D("8"), StandardCost=D("6"))])
    got = [(r.Name, r.ProfitMargin) for r in products.list_price_margin(p).collect()]
    assert got == [("P2", D("25.0000")), ("P1", None)]


def test_turnover_and_reorder(spark):
    p = product(spark, [dict(ProductID=1, ReorderPoint=10), dict(ProductID=2, ReorderPoint=10),
                        dict(ProductID=3, ReorderPoint=10)])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, OrderQty=5),
                       dict(SalesOrderID=1, ProductID=2, OrderQty=3),
                       dict(SalesOrderID=2, ProductID=3, OrderQty=3)])
    inv = frame(spark, "inventory", [(2, 1, 0), (3, 1, 4), (3, 2, 2)])
    turn = rows(products.inventory_turnover(d, p, inv), "ProductID", "iQty", "TurnOverRate")
    assert turn == [(1, None, None), (2, 0, None), (3, 6, D("0.50"))]
    low = rows(products.below_reorder_point(inv, p), "ProductID", "iQty")
    assert low == [(2, 0), (3, 6)]


def test_unsold_product_is_discontinued(spark):
    p = product(spark, [dict(ProductID=1, StandardCost=D("1")), dict(ProductID=2, StandardCost=D("1"))])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, OrderQty=300, LineTotal=D("5000"))])
    got = rows(products.product_recommendation(d, p), "Name", "UnitSold", "Profit", "Recommendation")
    assert got == [("P1", 300, D("4700.0000"), "Promote/InvestMore"),
                   ("P2", 0, D("0.0000"), "ConsiderDiscontinuing")]


def test_product_without_subcategory_drops_out(spark):
    p = product(spark, [dict(ProductID=1, ProductSubcategoryID="s"),
                        dict(ProductID=2, ProductSubcategoryID=None)])
    sub = frame(spark, "subcategory", [("s", "c")])
    cat = frame(spark, "category", [("c", "Bikes")])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, LineTotal=D("10")),
                       dict(SalesOrderID=1, ProductID=2, LineTotal=D("99"))])
    got = rows(products.category_profit(d, p, sub, cat), "Name", "Revenue")
    assert got == [("Bikes", D("10.0000"))]


# -- 04 operations -------------------------------------------------------------

def test_truncating_mean_days_and_late_on_due_date(spark):
    po = frame(spark, "po_header", [(1, 7, ts(2000, 1, 10), ts(2000, 1, 9)),
                                    (2, 7, ts(2000, 1, 10), ts(2000, 1, 8)),
                                    (3, 7, ts(2000, 1, 10), None)])
    # mean of -1 and -2 is -1.5 -> truncated toward zero -> -1
    assert operations.avg_fulfillment_days(po).first()[0] == -1
    vendor = frame(spark, "vendor", [(7, "V")])
    assert rows(operations.vendor_delivery_days(po, vendor), "VendorID", "DeliveryTime") == [(7, -1)]
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 1), DueDate=ts(2000, 2),
                            ShipDate=ts(2000, 2)),
                       dict(SalesOrderID=2, CustomerID=1, OrderDate=ts(2000, 1), DueDate=ts(2000, 2),
                            ShipDate=None),
                       dict(SalesOrderID=3, CustomerID=1, OrderDate=ts(2000, 1), DueDate=ts(2000, 2),
                            ShipDate=ts(2000, 1, 5))])
    r = operations.late_shipments(h).first()
    assert (r.NoLateShipment, r.LateShipmentsRatePercent) == (1, D("33.33"))
    assert operations.late_shipments(h, strict=True).first().NoLateShipment == 0


def test_inventory_unknown_product_and_location(spark):
    inv = frame(spark, "inventory", [(1, 1, 2), (9, 2, 5)])
    p = product(spark, [dict(ProductID=1, StandardCost=D("3"))])
    loc = frame(spark, "location", [(1, "A")])
    got = rows(operations.inventory_value_by_location(inv, p, loc), "LocationID", "LocationName", "COGS")
    assert got == [(1, "A", D("6.00")), (2, None, None)]


# -- 05 / 08 profit ---------------------------------------------------------------

def test_margin_divisor_skips_non_positive_lines(spark):
    p = product(spark, [dict(ProductID=1, StandardCost=D("10"))])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, OrderQty=1, LineTotal=D("4")),
                       dict(SalesOrderID=1, ProductID=1, OrderQty=1, LineTotal=D("-2")),
                       dict(SalesOrderID=1, ProductID=1, OrderQty=0, LineTotal=D("0"))])
    # (2 - 20) * 100 / 4 = -450
    got = rows(profit.negative_margin_products(d, p), "ProductName", "GrossProfitMargin")
    assert got == [("P1", D("-450.00"))]


def test_overstock_fan_out(spark):
    p = product(spark, [dict(ProductID=1)])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, OrderQty=2),
                       dict(SalesOrderID=2, ProductID=1, OrderQty=3)])
    inv = frame(spark, "inventory", [(1, 1, 100), (1, 2, 200), (1, 3, 300)])
    lit = rows(executive.overstock_risk(d, p, inv, max_orders=100, min_stock=0), "Orders", "iVolume")
    assert lit == [(15, 1200)]          # 5 units x 3 rows, 600 stock x 2 lines
    fixed = rows(executive.overstock_risk(d, p, inv, max_orders=100, min_stock=0, fan_out=False),
                 "Orders", "iVolume")
    assert fixed == [(5, 600)]


def test_discount_literal_vs_fractional(spark):
    p = product(spark, [dict(ProductID=1, StandardCost=D("50"))])
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 1))])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, UnitPrice=D("100"), UnitPriceDiscount=D("0.10"))])
    lit = profit.discount_margin_effect(d, h, p).first()
    assert lit.AvgDiscountedPrice == D("99.9000")          # 100 * 1 - 0.10
    frac = profit.discount_margin_effect(d, h, p, fractional_discount=True).first()
    assert frac.AvgDiscountedPrice == D("90.0000")
    assert frac.MarginRateWithDiscount == D("44.44")


def test_markup_guard_zero_cost(spark):
    p = product(spark, [dict(ProductID=1, StandardCost=D("0")), dict(ProductID=2, StandardCost=D("10"))])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, LineTotal=D("5")),
                       dict(SalesOrderID=1, ProductID=2, LineTotal=D("11"))])
    got = rows(executive.low_markup_high_volume(d, p, min_lines=0), "Name", "ProfitMarginPerc")
    assert got == [("P2", D("10.00"))]


# -- 06 geography ---------------------------------------------------------------

def test_zero_previous_revenue_and_single_year_region(spark):
    terr = frame(spark, "territory", [(1, "North", D("0")), (2, "South", D("0"))])
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, TerritoryID=1, OrderDate=ts(2000, 1), TotalDue=D("0")),
                       dict(SalesOrderID=2, CustomerID=1, TerritoryID=1, OrderDate=ts(2001, 1), TotalDue=D("5")),
                       dict(SalesOrderID=3, CustomerID=1, TerritoryID=2, OrderDate=ts(2001, 1), TotalDue=D("8"))])
    yoy = rows(geo.region_yoy_growth(h, terr), "Region", "YEAR", "Growth")
    assert yoy == [("North", 2001, None)]
    overall = rows(geo.region_overall_growth(h, terr), "Region", "FirstYear", "LastYear", "GrowthRate")
    assert overall == [("North", 2000, 2001, None), ("South", 2001, 2001, D("0.00"))]


def test_expansion_header_total_counted_per_line(spark):
    terr = frame(spark, "territory", [(1, "North", D("0"))])
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, TerritoryID=1, OrderDate=ts(2000, 1), TotalDue=D("10")),
                       dict(SalesOrderID=2, CustomerID=1, TerritoryID=1, OrderDate=ts(2001, 1), TotalDue=D("30"))])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, OrderQty=1), dict(SalesOrderID=1, ProductID=2, OrderQty=1),
                       dict(SalesOrderID=2, ProductID=1, OrderQty=4)])
    lit = geo.expansion_candidates(d, h, terr).first()
    # 2000: 10 x 2 lines = 20; 2001: 30 -> growth 50 %
    assert (lit.TotalOrders, lit.TotalSales, lit.AvgGrowthRate) == (6, D("50.00"), D("50.00"))
    fixed = geo.expansion_candidates(d, h, terr, order_grain=True).first()
    assert (fixed.TotalSales, fixed.AvgGrowthRate) == (D("40.00"), D("200.00"))


# -- 07 advanced ---------------------------------------------------------------

def test_rank_ties_share_and_gap(spark):
    p = product(spark, [dict(ProductID=i) for i in (1, 2, 3, 4)])
    sub = frame(spark, "subcategory", [("s", "c")])
    cat = frame(spark, "category", [("c", "Bikes")])
    d = detail(spark, [dict(SalesOrderID=1, ProductID=1, LineTotal=D("9")),
                       dict(SalesOrderID=1, ProductID=2, LineTotal=D("9")),
                       dict(SalesOrderID=1, ProductID=3, LineTotal=D("5")),
                       dict(SalesOrderID=1, ProductID=4, LineTotal=D("1"))])
    got = rows(advanced.rank_products_in_category(d, p, sub, cat), "ProductName", "RNK")
    assert got == [("P1", 1), ("P2", 1), ("P3", 3), ("P4", 4)]


def test_row_based_lag_and_january_label(spark):
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 11), TotalDue=D("10")),
                       dict(SalesOrderID=2, CustomerID=1, OrderDate=ts(2001, 1), TotalDue=D("20"))])
    got = rows(advanced.mom_growth(h), "SalesYear", "SalesMonth", "PrevSalesMonth", "PrevYearSales", "GrowthRate")
    # December is missing: January's previous row is November
    assert got == [(2000, 11, 10, D("0"), D("0.00")), (2001, 1, 0, D("10"), D("100.00"))]
    roll = rows(advanced.rolling_avg_sales(h), "SalesMonth", "Rolling3MonthAvgSales")
    assert roll == [(dt.date(2000, 11, 1), D("10.00")), (dt.date(2001, 1, 1), D("15.00"))]


def test_pareto_dominant_entity_gives_empty_result(spark):
    cust = frame(spark, "customer", [(1, None, 1), (2, None, 2)])
    h = header(spark, [dict(SalesOrderID=1, CustomerID=1, OrderDate=ts(2000, 1), SubTotal=D("90")),
                       dict(SalesOrderID=2, CustomerID=2, OrderDate=ts(2000, 1), SubTotal=D("10"))])
    assert advanced.pareto_customers(h, cust).count() == 0
    got = rows(advanced.pareto_customers(h, cust, cutoff="0.9"), "CustomerID", "CummulativeRevenuePercent")
    assert got == [(1, D("90.00"))]


def test_rfm_fewer_rows_than_tiles(spark):
    cust = frame(spark, "customer", [(1, None, 1), (2, None, 2), (3, None, 3)])
    orders = [(1, 1, ts(2001, 7), "5"), (2, 2, ts(2001, 1), "50"), (3, 2, ts(2001, 2), "50"),
              (4, 3, ts(2000, 1), "1")]
    h = header(spark, [dict(SalesOrderID=o, CustomerID=c, OrderDate=d, TotalDue=D(v), SubTotal=D(v))
                       for o, c, d, v in orders])
    got = rows(advanced.rfm(cust, h, dt.date(2001, 8, 1)), "CustomerID", "Recency", "Frequency", "RFM")
    # 3 rows, 5 tiles: tile = position.  R (recency desc): 3, 2, 1;
    # F (frequency asc, id tie-break): 1, 3, 2;  M (monetary asc): 3, 1, 2
    assert got == [(1, 31, 1, "312"), (2, 181, 2, "233"), (3, 578, 1, "121")]
    tiles = rows(executive.top_revenue_customers_tile(h, cust), "CustomerID", "RevenueGroup")
    assert tiles == [(2, 1)]


def test_top_quintile_share_format(spark):
    cust = frame(spark, "customer", [(i, None, i) for i in range(1, 8)])
    h = header(spark, [dict(SalesOrderID=i, CustomerID=i, OrderDate=ts(2000, 1)) for i in range(1, 8)])
    d = detail(spark, [dict(SalesOrderID=i, ProductID=1, LineTotal=D(i)) for i in range(1, 8)])
    # 7 customers -> tile 1 holds 2 (7 and 6): 13 / 28 = 46.43 %
    assert sales.top_quintile_revenue_share(h, cust, d).first()[0] == "46.43%"
