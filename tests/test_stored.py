"""Facts bucketed by order and partitioned by month."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks import compare, duckdb_connection, physical_plan
from ledgerlens.operators import profit, sales
from ledgerlens.plans.oracle import ORACLE_SQL
from ledgerlens.plans.registry import QUERIES
from ledgerlens.sources import SalesData, StoredData, store
from ledgerlens.sources.stored import bucket_count


@pytest.fixture(scope="module")
def stored(spark, sf_small, tmp_path_factory):
    place = tmp_path_factory.mktemp("warehouse")
    spark.sql(f"CREATE DATABASE kept LOCATION '{place}'")
    store(SalesData(spark, sf_small), "kept", buckets=4)
    yield StoredData(spark, "kept")
    spark.sql("DROP DATABASE kept CASCADE")


@pytest.mark.parametrize("name", [q for q in sorted(QUERIES) if q[1:5] in ("01_6", "03_2", "04_5", "05_1", "05_3", "05_4", "05_6", "06_5", "07_5")])
def test_queries_over_stored_tables(spark, sf_small, stored, name):
    assert compare(QUERIES[name](spark, stored), duckdb_connection(sf_small), ORACLE_SQL[name])["match"]


@pytest.mark.parametrize("name", ["q05_1_gross_profit_by_product_category_year", "q05_3_shrinking_margins",
                                  "q05_4_discount_margin_effect", "q05_6_high_revenue_low_profit_territories",
                                  "q06_5_expansion_candidates_corrected"])
def test_order_key_joins_shuffle_nothing(spark, stored, monkeypatch, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical_plan(QUERIES[name](spark, stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SalesOrderID" in text
    assert not re.search(r"hashpartitioning\(SalesOrderID", text)


def files(df):
    """Files and partitions that the scans of a result read."""
    df.collect()
    out = []

    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            return walk(node.plan())
        if "FileSourceScanExec" in node.getClass().getSimpleName():
            out.append((node.relation().location().toString(), node.metrics().get("numFiles").get().value()))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return [n for _, n in out]


def test_a_date_bound_reads_its_months(spark, stored):
    whole = sales.revenue_by_period(stored.header().withColumnRenamed("TotalDue", "LineTotal"))
    bound = stored.header(since=dt.date(2001, 1, 1), until=dt.date(2001, 3, 15))
    text = physical_plan(bound)
    assert re.search(r"PartitionFilters: \[[^\]]*OrderMonth", text)
    assert sum(files(bound)) <= 3 * 4 < sum(files(whole))
    want = stored.header().where("OrderDate >= '2001-01-01' and OrderDate < '2001-03-16'")
    assert sorted(r.SalesOrderID for r in bound.collect()) == sorted(r.SalesOrderID for r in want.collect())
    assert sum(files(stored.territory())) < sum(files(stored.header()))


def test_bounded_lines_join_bounded_orders(spark, stored):
    a, b = dt.date(1998, 2, 10), dt.date(1998, 4, 9)
    lines = stored.detail(since=a, until=b)
    got = lines.join(stored.header(since=a, until=b).select("SalesOrderID"), "SalesOrderID", "left_semi")
    want = stored.detail().join(stored.header(since=a, until=b).select("SalesOrderID"), "SalesOrderID", "left_semi")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert sum(files(lines)) <= 3 * 4


def test_lines_of_some_orders_prune_at_run_time(spark, stored):
    chosen = "OrderDate >= '1999-05-01' and OrderDate < '1999-06-01' and TotalDue > 0"
    lines = stored.lines_of(chosen)
    assert "dynamicpruning" in physical_plan(lines).lower()
    want = stored.detail().join(stored.header().where(chosen).select("SalesOrderID"), "SalesOrderID", "left_semi")
    assert sorted(map(tuple, lines.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_lines_without_an_order_and_orders_without_a_date_stay(spark, sf_small):
    d = SalesData(spark, sf_small)

    class Odd:
        spark = d.spark
        header = staticmethod(lambda **k: d.header(territory=True, ship_date=True).where("SalesOrderID > 100").withColumn(
            "OrderDate", F.when(F.col("SalesOrderID") > 200, F.col("OrderDate"))))
        detail = staticmethod(d.detail)

    store(Odd, "odd", buckets=2, tables=("header", "detail"))
    try:
        got = StoredData(spark, "odd")
        assert got.detail().count() == d.detail().count() and got.header().count() == Odd.header().count()
        args = (d.product(),)
        assert (sorted(map(tuple, profit.shrinking_margins(got.detail(), got.header(), *args).collect()), key=str)
                == sorted(map(tuple, profit.shrinking_margins(d.detail(), Odd.header(), *args).collect()), key=str))
    finally:
        spark.sql("DROP DATABASE odd CASCADE")


def test_bucket_count():
    assert [bucket_count(b) for b in (0, 1 << 30, (1 << 30) + 1, 100 << 40)] == [1, 1, 2, 1 << 17]
