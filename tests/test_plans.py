"""Physical-plan shape: pushdown, pruning, top-k, no row funnel into one task."""

import re

import pytest

from checks import physical_plan
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources import SalesData
from ledgerlens import pinned
from ledgerlens.operators import operations, ordered


def plan(spark, sf, name):
    return physical_plan(QUERIES[name](spark, sf))


def test_filter_and_columns_reach_the_scan(spark, sf_small, tmp_path):
    # On a stored purchase-order table the IS NOT NULL filter and the column
    # selection reach the Parquet scan.
    d = SalesData(spark, sf_small)
    path = str(tmp_path / "po_header")
    d.po_header().write.parquet(path)
    text = physical_plan(operations.avg_fulfillment_days(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(ShipDate)]" in text
    assert "ReadSchema: struct<OrderDate:timestamp_ntz,ShipDate:timestamp_ntz>" in text
    # derived tables still prune to the needed lineitem columns
    text = physical_plan(operations.avg_fulfillment_days(d.po_header()))
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text


@pytest.mark.parametrize("name", ["q01_2_top_product_by_revenue", "q01_3_top_customers_by_lifetime_sales",
                                  "q02_7_top_repeat_customers", "q08_1_priority_products",
                                  "q08_2_loyalty_candidates"])
def test_top_k_is_distributed(spark, sf_small, name):
    assert "TakeOrderedAndProject" in plan(spark, sf_small, name)


@pytest.mark.parametrize("name", ["q01_7_top_quintile_revenue_share", "q07_5_rfm", "q07_7_pareto_products",
                                  "q07_8_pareto_customers", "q08_8_top_revenue_customers_tile",
                                  "q07_1_rank_products_in_category"])
def test_entity_windows_do_not_funnel_rows(spark, sf_small, monkeypatch, name):
    """Global NTILE / running sums / category ranks are computed by
    ``ordered_stats``: a single-partition exchange, in the plan of the result
    or of a table written on the way, only carries the per-partition summary."""
    plans = []
    write = pinned.pin
    for module in (ordered,):
        monkeypatch.setattr(module, "pin", lambda df, n="x": (plans.append(physical_plan(df)), write(df, n))[1])
    plans.append(plan(spark, sf_small, name))
    # tiles are found by counting and write nothing (test_selection.py)
    assert len(plans) > 1 or name.startswith(("q01_7", "q07_5", "q08_8"))
    for text in plans:
        lines = text.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "keys=[_ord_pid" in lines[i + 1] or "functions=[partial_" in lines[i + 1], lines[i:i + 3]


def test_fan_out_query_has_no_many_to_many_join(spark, sf_small):
    # 08.5 folds both sides to one row per product before joining them: each
    # side of the first join of facts is an aggregate, not a scan
    text = plan(spark, sf_small, "q08_5_overstock_risk")
    assert text.count("Scan parquet") == text.count("FileScan") or "HashAggregate" in text
    joined = [line for line in text.splitlines() if "Join" in line]
    folded = [line for line in text.splitlines() if "HashAggregate(keys=[ProductID" in line and "partial" not in line]
    assert len(folded) >= 2 and len(joined) <= 2


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["q05_6_high_revenue_low_profit_territories", "q08_3_loss_making_territories"])
def test_lines_are_not_shuffled_on_the_product(spark, sf_small, no_broadcast, name):
    """Cost is joined after the fold: the only rows exchanged on ProductID alone
    are folded ones and the product table."""
    lines = plan(spark, sf_small, name).splitlines()
    for i, line in enumerate(lines):
        if re.search(r"hashpartitioning\(ProductID#\d+L?, \d+\)", line):
            below = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below or "p_partkey" in below, below


def test_names_join_after_the_pairs(spark, sf_small, no_broadcast):
    df = QUERIES["q03_2_products_bought_together"](spark, sf_small)
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return re.search(r"[A-Z]", line).start()

    top = next(i for i, line in enumerate(lines) if "Aggregate [item_a" in line)
    below = next((i for i in range(top + 1, len(lines)) if depth(lines[i]) <= depth(lines[top])), len(lines))
    assert "p_name" not in "".join(lines[top:below]) and "p_name" in "".join(lines[below:])


def test_stock_is_read_once(spark, sf_small, no_broadcast):
    df = QUERIES["q03_3_overstocked_low_sellers"](spark, sf_small)
    df.collect()
    final = physical_plan(df).split("== Initial Plan ==")[0]
    assert final.count("lineitem.parquet") <= 2 and "ReusedExchange" in final
