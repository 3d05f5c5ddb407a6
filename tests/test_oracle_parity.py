"""Every registered query against its DuckDB statement on the driver data.

Runs at sf0.001 by default; set LEDGERLENS_PARITY_SF=/root/testdata/sf0.01
for the driver's scale.
"""

import pytest

from checks import compare, duckdb_connection
from ledgerlens.plans.oracle import ORACLE_SQL
from ledgerlens.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf_parity):
    return duckdb_connection(sf_parity)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, sf_parity, name):
    res = compare(QUERIES[name](spark, sf_parity), con, ORACLE_SQL[name])
    assert res["columns_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["match"], res


@pytest.fixture(params=["200 partitions", "Tokyo", "not ANSI", "not adaptive"])
def setting(spark, request):
    key, value = {"200 partitions": ("spark.sql.shuffle.partitions", "200"),
                  "Tokyo": ("spark.sql.session.timeZone", "Asia/Tokyo"),
                  "not ANSI": ("spark.sql.ansi.enabled", "false"),
                  "not adaptive": ("spark.sql.adaptive.enabled", "false")}[request.param]
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    yield
    spark.conf.set(key, before)


#: One statement of each kind: dates, ratios, tiles, ranks, running sums, pairs, streaks.
SAMPLE = ["q01_1_revenue_by_period", "q02_3_lapsed_customers", "q02_8_consecutive_month_streaks", "q04_1_avg_fulfillment_days",
          "q05_4_discount_margin_effect_corrected", "q07_1_rank_products_in_category", "q07_5_rfm",
          "q07_7_pareto_products", "q07_9_rolling_avg_sales", "q08_8_top_revenue_customers_tile"]


@pytest.mark.parametrize("name", SAMPLE)
def test_matches_oracle_under_other_settings(spark, con, sf_parity, setting, name):
    assert compare(QUERIES[name](spark, sf_parity), con, ORACLE_SQL[name])["match"]
