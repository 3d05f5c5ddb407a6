"""Every operator as a query over the driver tables: name -> (spark, sf_dir) -> DataFrame.

Names are ``q`` + the statement ID (file_statement) + the operator name;
``_corrected`` marks the variants that fix a literal quirk of the reference.
Parameters are the test values of SURVEY §7.3 where the literal thresholds
leave the synthetic data empty; the operators' defaults keep the literals.
The same parameters appear in ``oracle.py``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import (advanced, customers, executive, geo, operations, products, profit,
                         sales)
from ..sources import SalesData

AS_OF = dt.date(2001, 8, 1)          # last order date of the test data ("now")
STREAK_MIN = 3
LOW_SELLER_MAX = 500
RECO = dict(discontinue_units=600, discontinue_profit=0, promote_units=900, promote_profit=500000)
HRLP = dict(min_revenue=600_000_000, max_profit=45_000_000)
LOSS_TERR = dict(min_lines=5000, max_profit=42_000_000)
OVERSTOCK = dict(max_orders=10000, min_stock=3000)
OVERSTOCK_PLAIN = dict(max_orders=500, min_stock=50)   # unmultiplied sums are ~30x smaller
MARKUP = dict(max_markup="0.3", min_lines=30)

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[SalesData], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir) -> DataFrame:
        # a folder of the driver's files, or a source of canonical tables
        return fn(sf_dir if hasattr(sf_dir, "header") else SalesData(spark, sf_dir))
    return run


QUERIES: dict[str, Query] = {
    # 01 sales performance
    "q01_1_revenue_by_period": _q(lambda d: sales.revenue_by_period(d.detail())),
    "q01_2_top_product_by_revenue": _q(lambda d: sales.top_product_by_revenue(d.product(), d.detail())),
    "q01_3_top_customers_by_lifetime_sales": _q(
        lambda d: sales.top_customers_by_lifetime_sales(d.header(), d.customer(), d.detail())),
    "q01_4_average_order_value_by_year": _q(lambda d: sales.average_order_value_by_year(d.detail())),
    "q01_4_average_order_value_by_year_corrected": _q(
        lambda d: sales.average_order_value_by_year(d.detail(), distinct_orders=True)),
    "q01_5_online_share_by_month": _q(lambda d: sales.online_share_by_month(d.header())),
    "q01_6_revenue_by_territory": _q(lambda d: sales.revenue_by_territory(d.territory())),
    "q01_7_top_quintile_revenue_share": _q(
        lambda d: sales.top_quintile_revenue_share(d.header(), d.customer(), d.detail())),
    "q01_8_declining_products": _q(lambda d: sales.declining_products(d.product(), d.detail())),
    # 02 customers
    "q02_1_new_customers_by_year": _q(lambda d: customers.new_customers_by_year(d.header())),
    "q02_2_yearly_retention": _q(lambda d: customers.yearly_retention(d.header())),
    "q02_3_lapsed_customers": _q(lambda d: customers.lapsed_customers(d.customer(), d.header(), AS_OF)),
    "q02_4_avg_purchase_frequency": _q(lambda d: customers.avg_purchase_frequency(d.header())),
    "q02_5_revenue_by_segment": _q(lambda d: customers.revenue_by_segment(d.header(), d.customer())),
    "q02_6_clv_by_segment": _q(lambda d: customers.clv_by_segment(d.header(), d.customer())),
    "q02_7_top_repeat_customers": _q(lambda d: customers.top_repeat_customers(d.header())),
    "q02_8_consecutive_month_streaks": _q(
        lambda d: customers.consecutive_month_streaks(d.header(), STREAK_MIN)),
    "q02_8_consecutive_month_streaks_corrected": _q(
        lambda d: customers.consecutive_month_streaks(d.header(), STREAK_MIN, distinct_months=True)),
    # 03 products and inventory
    "q03_1_list_price_margin": _q(lambda d: products.list_price_margin(d.product())),
    "q03_2_products_bought_together": _q(
        lambda d: products.products_bought_together(d.detail(), d.product())),
    "q03_2_products_bought_together_corrected": _q(
        lambda d: products.products_bought_together(d.detail(), d.product(), distinct_orders=True)),
    "q03_3_overstocked_low_sellers": _q(
        lambda d: products.overstocked_low_sellers(d.detail(), d.product(), d.inventory(), LOW_SELLER_MAX)),
    "q03_4_inventory_turnover": _q(
        lambda d: products.inventory_turnover(d.detail(), d.product(), d.inventory())),
    "q03_5_below_reorder_point": _q(lambda d: products.below_reorder_point(d.inventory(), d.product())),
    "q03_6_category_profit": _q(
        lambda d: products.category_profit(d.detail(), d.product(), d.subcategory(), d.category())),
    "q03_7_product_recommendation": _q(
        lambda d: products.product_recommendation(d.detail(), d.product(), **RECO)),
    # 04 operations
    "q04_1_avg_fulfillment_days": _q(lambda d: operations.avg_fulfillment_days(d.po_header())),
    "q04_2_vendor_delivery_days": _q(lambda d: operations.vendor_delivery_days(d.po_header(), d.vendor())),
    "q04_3_late_shipments": _q(lambda d: operations.late_shipments(d.header(ship_date=True))),
    "q04_3_late_shipments_corrected": _q(
        lambda d: operations.late_shipments(d.header(ship_date=True), strict=True)),
    "q04_4_inventory_value_by_location": _q(
        lambda d: operations.inventory_value_by_location(d.inventory(), d.product(), d.location())),
    "q04_5_purchase_cost_trend": _q(
        lambda d: operations.purchase_cost_trend(d.po_header(line_total=True), None, d.vendor())),
    # 05 profitability
    "q05_1_gross_profit_by_product_category_year": _q(
        lambda d: profit.gross_profit_by_product_category_year(
            d.detail(), d.header(), d.product(), d.subcategory(), d.category())),
    "q05_2_negative_margin_products": _q(lambda d: profit.negative_margin_products(d.detail(), d.product())),
    "q05_3_shrinking_margins": _q(lambda d: profit.shrinking_margins(d.detail(), d.header(), d.product())),
    "q05_4_discount_margin_effect": _q(
        lambda d: profit.discount_margin_effect(d.detail(), d.header(), d.product())),
    "q05_4_discount_margin_effect_corrected": _q(
        lambda d: profit.discount_margin_effect(d.detail(), d.header(), d.product(), fractional_discount=True)),
    "q05_5_profit_per_customer": _q(lambda d: profit.profit_per_customer(d.detail(), d.header(), d.product())),
    "q05_6_high_revenue_low_profit_territories": _q(
        lambda d: profit.high_revenue_low_profit_territories(
            d.detail(), d.header(territory=True), d.product(), **HRLP)),
    # 06 geography
    "q06_1_sales_by_geography": _q(
        lambda d: geo.sales_by_geography(d.header(), d.address(), d.state_province(), d.country_region())),
    "q06_2_region_yoy_growth": _q(lambda d: geo.region_yoy_growth(d.header(territory=True), d.territory())),
    "q06_3_region_overall_growth": _q(
        lambda d: geo.region_overall_growth(d.header(territory=True), d.territory())),
    "q06_4_region_average_order_value": _q(
        lambda d: geo.region_average_order_value(d.header(territory=True), d.territory())),
    "q06_5_expansion_candidates": _q(
        lambda d: geo.expansion_candidates(d.detail(), d.header(territory=True), d.territory())),
    "q06_5_expansion_candidates_corrected": _q(
        lambda d: geo.expansion_candidates(d.detail(), d.header(territory=True), d.territory(),
                                           order_grain=True)),
    # 07 advanced analytics
    "q07_1_rank_products_in_category": _q(
        lambda d: advanced.rank_products_in_category(d.detail(), d.product(), d.subcategory(), d.category())),
    "q07_2_yoy_growth": _q(lambda d: advanced.yoy_growth(d.header())),
    "q07_3_mom_growth": _q(lambda d: advanced.mom_growth(d.header())),
    "q07_4_seasonality": _q(lambda d: advanced.seasonality(d.header())),
    "q07_5_rfm": _q(lambda d: advanced.rfm(d.customer(), d.header(), AS_OF)),
    "q07_6_churn_risk": _q(lambda d: advanced.churn_risk(d.customer(), d.header(), AS_OF)),
    "q07_7_pareto_products": _q(lambda d: advanced.pareto_products(d.detail(), d.product())),
    "q07_8_pareto_customers": _q(lambda d: advanced.pareto_customers(d.header(), d.customer())),
    "q07_9_rolling_avg_sales": _q(lambda d: advanced.rolling_avg_sales(d.header())),
    "q07_10_sales_anomalies": _q(lambda d: advanced.sales_anomalies(d.header())),
    # 08 executive
    "q08_1_priority_products": _q(lambda d: executive.priority_products(d.detail(), d.product())),
    "q08_2_loyalty_candidates": _q(lambda d: executive.loyalty_candidates(d.header(), d.customer())),
    "q08_3_loss_making_territories": _q(
        lambda d: executive.loss_making_territories(d.detail(), d.header(territory=True), d.product(),
                                                    **LOSS_TERR)),
    "q08_4_growth_drivers": _q(lambda d: executive.growth_drivers(d.header())),
    "q08_5_overstock_risk": _q(
        lambda d: executive.overstock_risk(d.detail(), d.product(), d.inventory(), **OVERSTOCK)),
    "q08_5_overstock_risk_corrected": _q(
        lambda d: executive.overstock_risk(d.detail(), d.product(), d.inventory(), fan_out=False,
                                           **OVERSTOCK_PLAIN)),
    "q08_6_loss_making_products": _q(lambda d: executive.loss_making_products(d.detail(), d.product())),
    "q08_7_low_markup_high_volume": _q(
        lambda d: executive.low_markup_high_volume(d.detail(), d.product(), **MARKUP)),
    "q08_8_top_revenue_customers_tile": _q(
        lambda d: executive.top_revenue_customers_tile(d.header(), d.customer())),
}
