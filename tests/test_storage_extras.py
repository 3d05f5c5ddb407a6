"""Key profile, distinct sketches, incremental folds and SQL table functions."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import advanced, customers, products, profit
from ledgerlens.operators.keys import REFERENCES, UNIQUE, key_profile
from ledgerlens.operators.sketches import distinct_estimate, distinct_sketches, error_bound, roll_up
from ledgerlens.plans import registry, table_functions
from ledgerlens.sources import SalesData
from ledgerlens.sources.folds import HeaderFolds


@pytest.fixture(scope="module")
def data(spark, sf_small):
    return SalesData(spark, sf_small)


class Small:
    """A source of a few rows; tables not given are those of another source."""

    def __init__(self, base, **tables):
        self.base, self.tables = base, tables

    def header(self, territory=False, ship_date=False):
        return self.tables.get("header") or self.base.header(territory, ship_date)

    def __getattr__(self, name):
        df = self.tables.get(name)
        return (lambda: df) if df is not None else getattr(self.base, name)


def test_key_profile_finds_repeats_nulls_and_orphans(spark, data):
    customer = spark.createDataFrame([(1, None, None), (1, None, None), (2, 5, None), (None, 5, None), (None, 6, None)],
                                     "CustomerID long, StoreID long, PersonID long")
    header = spark.createDataFrame([(10, 1, 7, 3), (11, 1, 7, 3), (12, 9, 7, 3), (12, None, 7, 3)],
                                   "SalesOrderID long, CustomerID long, TerritoryID long, ShipToAddressID long")
    got = {(r.TableName, r.KeyColumns, r.RefersTo): tuple(r)[3:] for r in key_profile(Small(data, customer=customer, header=header)).collect()}
    assert len(got) == len(UNIQUE) + len(REFERENCES)
    assert got["customer", "CustomerID", ""] == (5, 2, 1, 2, 0)
    assert got["header", "SalesOrderID", ""] == (4, 3, 1, 0, 0)
    assert got["header", "CustomerID", "customer.CustomerID"] == (4, 2, 1, 1, 1)


def test_a_repeated_customer_changes_an_inner_join_only(spark, data):
    """Why the profile matters: the operators' existence joins count a repeated
    customer once, an inner join twice."""
    twice = data.customer().union(data.customer().limit(1))
    row = {r.TableName: r for r in key_profile(Small(data, customer=twice), references=()).collect()}["customer"]
    assert row.RepeatedRows == 1
    h, d = data.header(), data.detail()
    one = advanced.pareto_customers(h, data.customer(), "0.5").collect()
    assert advanced.pareto_customers(h, twice, "0.5").collect() == one
    assert h.join(twice, "CustomerID").count() >= h.join(data.customer(), "CustomerID").count()
    assert d.count() > 0


def test_key_profile_of_empty_tables(spark, data):
    none = data.customer().limit(0)
    got = [tuple(r)[3:] for r in key_profile(Small(data, customer=none), unique=(("customer", ("CustomerID",)),),
                                             references=(("customer", "StoreID", "territory", "TerritoryID"),)).collect()]
    assert got == [(0, 0, 0, 0, 0)] * 2


@pytest.mark.parametrize("lg_k", [10, 14])
def test_rolled_up_sketches_stay_within_the_bound(spark, lg_k):
    """Months rolled up to years and to all: values counted in several months."""
    facts = spark.range(300_000).select((F.col("id") % 3).alias("store"), (F.xxhash64("id") % 60_000).alias("customer"),
                                        (1 + F.floor(F.col("id") / 3) % 24).alias("month"))
    monthly = distinct_sketches(facts, "customer", ["store", "month"], lg_k)
    assert monthly.count() == 72 and {f.dataType.simpleString() for f in monthly.schema if f.name == "Sketch"} == {"binary"}
    year = F.ceil(F.col("month") / 12).alias("year")
    for got, want in (
            (roll_up(monthly, ["store", year]), facts.groupBy("store", year).agg(F.count_distinct("customer").alias("n"), F.count("*").alias("l"))),
            (roll_up(roll_up(monthly, ["store"]), [F.lit(0).alias("all")]), facts.agg(F.lit(0).alias("all"), F.count_distinct("customer").alias("n"),
                                                                                    F.count("*").alias("l")))):
        keys = [c for c in want.columns if c not in ("n", "l")]
        rows = distinct_estimate(got).join(want, keys).collect()
        assert rows and all(r.Lines == r.l and abs(r.Distinct - r.n) <= error_bound(lg_k) * r.n for r in rows)


def test_sketches_of_strings_nulls_and_few_values(spark):
    facts = spark.createDataFrame([("a", "x"), ("a", None), ("a", "y"), ("b", None), ("a", "x")], "k string, v string")
    got = {r.k: (r.Distinct, r.Lines) for r in distinct_estimate(distinct_sketches(facts, "v", ["k"])).collect()}
    assert got == {"a": (2, 4), "b": (0, 1)}
    days = spark.createDataFrame([(dt.date(2000, 1, 1 + i % 9), D(i % 4)) for i in range(40)], "d date, m decimal(10,2)")
    assert [r.Distinct for c in ("d", "m") for r in distinct_estimate(distinct_sketches(days, c, [])).collect()] == [9, 4]


COLUMNS = {"CustomerID": "o_custkey", "OrderDate": "o_orderdate", "TotalDue": "cast(o_totalprice as decimal(18,2))"}


def test_append_equals_a_full_run(spark, data, tmp_path):
    orders = data.raw("orders").select("o_custkey", "o_orderdate", "o_totalprice")
    files, state = f"{tmp_path}/orders", f"{tmp_path}/state with space"
    parts = orders.randomSplit([0.5, 0.3, 0.2], seed=3)
    folds = HeaderFolds(spark, files, state, COLUMNS)
    parts[0].repartition(2).write.parquet(files)
    with pytest.raises(ValueError):
        folds.months()
    assert folds.refresh() == 2 and folds.refresh() == 0
    parts[1].repartition(1).write.mode("append").parquet(files)
    assert folds.pending().count() == 1                                   # only the new file
    assert folds.refresh() == 1
    parts[2].repartition(3).write.mode("append").parquet(files)
    assert folds.refresh() == 3

    def same(operator, got, want):
        assert sorted(map(tuple, operator(got).collect()), key=str) == sorted(map(tuple, operator(want).collect()), key=str)

    header = data.header()
    for operator in (advanced.yoy_growth, advanced.mom_growth, advanced.rolling_avg_sales, advanced.sales_anomalies):
        same(operator, folds.months(), header)
    for operator in (customers.new_customers_by_year, customers.yearly_retention):
        same(operator, folds.customer_months(), header)
    assert folds.months().agg(F.sum("Orders")).first()[0] == header.count()


def test_changed_and_removed_files_are_not_counted(spark, tmp_path):
    files, state = tmp_path / "orders", f"{tmp_path}/state"

    def write(name, total):
        spark.createDataFrame([(1, dt.datetime(2000, 5, 6), D(total))], "CustomerID long, OrderDate timestamp_ntz, TotalDue decimal(18,2)") \
            .coalesce(1).write.mode("overwrite").parquet(str(files / name))

    def total():
        return [r.TotalDue for r in folds.months().collect()]

    folds = HeaderFolds(spark, str(files), state)
    write("a", 5), write("b", 7)
    folds.refresh()
    assert total() == [D(12)]
    write("b", 100)                                                       # overwritten
    assert total() == [D(5)]
    folds.refresh()
    assert total() == [D(105)]


def test_an_unmarked_batch_is_folded_again(spark, tmp_path, monkeypatch):
    files = f"{tmp_path}/orders"
    spark.createDataFrame([(1, dt.datetime(2000, 5, 6), D(5))], "CustomerID long, OrderDate timestamp_ntz, TotalDue decimal(18,2)") \
        .write.parquet(files)
    folds = HeaderFolds(spark, files, f"{tmp_path}/state")
    create = type(spark).createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):                                # fails before the marks
        folds.refresh()
    monkeypatch.setattr(type(spark), "createDataFrame", create)
    assert folds.refresh() >= 1
    assert [r.TotalDue for r in folds.months().collect()] == [D(5)]


AS_OF = "DATE'2001-08-01'"


def test_functions_equal_their_operators(spark, data):
    names = table_functions.register(data, "fn")
    assert set(names) == {f"fn_{n}" for n in table_functions.FUNCTIONS}

    def same(call, want):
        got = spark.sql(f"SELECT * FROM fn_{call}")
        assert got.columns == want.columns
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)

    h, c, d, p = data.header(), data.customer(), data.detail(), data.product()
    day = registry.AS_OF
    same(f"lapsed_customers({AS_OF})", customers.lapsed_customers(c, h, day))
    same(f"lapsed_customers(months => 3, as_of => {AS_OF})", customers.lapsed_customers(c, h, day, 3))
    same(f"rfm({AS_OF})", advanced.rfm(c, h, day))
    same("rfm(DATE'2003-01-31')", advanced.rfm(c, h, dt.date(2003, 1, 31)))
    same(f"churn_risk({AS_OF}, 3)", advanced.churn_risk(c, h, day, r_score=3))
    same(f"churn_risk({AS_OF})", advanced.churn_risk(c, h, day))
    same("overstocked_low_sellers(500)", products.overstocked_low_sellers(d, p, data.inventory(), 500))
    t = data.header(territory=True)
    for low, high in ((10_000_000, 5_000_000), (1000, 10 ** 9)):
        same(f"high_revenue_low_profit_territories({low}, {high})", profit.high_revenue_low_profit_territories(d, t, p, low, high))
    reco = registry.RECO
    same("product_recommendation(" + ", ".join(f"{k} => {v}" for k, v in reco.items()) + ")", products.product_recommendation(d, p, **reco))
    same("product_recommendation()", products.product_recommendation(d, p))


def test_a_callers_filter_reaches_the_scan(spark, data):
    table_functions.register(data, "fn")
    text = spark.sql(f"SELECT CustomerID FROM fn_lapsed_customers({AS_OF}) WHERE CustomerID = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_custkey,7)" in text
