"""The distributed ordering operators equal Spark's single-partition windows."""

import random
from decimal import Decimal as D

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.ordered import ordered_stats, with_ntile, with_rank, with_running_sum
from checks import physical_plan, single_partition_exchanges
from ledgerlens import pinned


def _data(spark, n, seed=7, groups=3, distinct_values=6):
    rnd = random.Random(seed)
    rows = [(i, f"g{rnd.randrange(groups)}", D(rnd.randrange(distinct_values)) / 4 - D("0.5"))
            for i in range(n)]
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("g", T.StringType()),
                           T.StructField("v", T.DecimalType(18, 2))])
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("n,parts", [(1, 4), (3, 4), (4, 2), (5, 3), (37, 4), (400, 7)])
def test_ntile_equals_window(spark, n, parts):
    df = _data(spark, n)
    order = [F.desc("v"), F.asc("k")]
    got = {r.k: r.t for r in with_ntile(df, order, 5, "t", num_partitions=parts).collect()}
    want = {r.k: r.t for r in df.select("k", F.ntile(5).over(Window.orderBy(*order)).alias("t")).collect()}
    assert got == want


def test_ntile_sizes_differ_by_at_most_one(spark):
    for n in range(1, 40):
        df = spark.range(n).withColumnRenamed("id", "k")
        counts = [r["count"] for r in with_ntile(df, [F.asc("k")], 5, "t", num_partitions=3)
                  .groupBy("t").count().collect()]
        assert max(counts) - min(counts) <= 1
        assert sum(counts) == n


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_running_sum_equals_window(spark, parts):
    df = _data(spark, 300, seed=3)
    order = [F.desc("v"), F.asc("k")]
    got = {r.k: (r._cum, r._total) for r in with_running_sum(df, order, "v", num_partitions=parts).collect()}
    w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = {r.k: (r.c, r.t) for r in df.select("k", F.sum("v").over(w).alias("c"),
                                                 F.sum("v").over(Window.partitionBy()).alias("t")).collect()}
    assert got == want


@pytest.mark.parametrize("parts", [2, 5])
def test_grouped_row_numbers_and_sums(spark, parts):
    df = _data(spark, 250, seed=11, groups=4)
    order = [F.asc("v"), F.asc("k")]
    got = {r.k: (r._rn, r._n, r._cum) for r in
           ordered_stats(df, order, ["g"], sum_col="v", num_partitions=parts).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = {r.k: (r.rn, r.n, r.c) for r in df.select(
        "k", F.row_number().over(w).alias("rn"), F.count("*").over(Window.partitionBy("g")).alias("n"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c")).collect()}
    assert got == want


def test_rank_with_ties_equals_window(spark):
    df = _data(spark, 200, seed=5, groups=3, distinct_values=4)   # many ties
    got = {r.k: r.rk for r in with_rank(df, ["g"], "v", "rk", tie_break=["k"], num_partitions=3).collect()}
    want = {r.k: r.rk for r in df.select("k", F.rank().over(
        Window.partitionBy("g").orderBy(F.desc("v"))).alias("rk")).collect()}
    assert got == want


def test_integral_running_sum(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = {r.k: r._cum for r in with_running_sum(df, [F.asc("k")], "v", num_partitions=4).collect()}
    assert got[99] == sum(i % 7 for i in range(100))
    assert got[10] == sum(i % 7 for i in range(11))


def test_empty_input(spark):
    df = _data(spark, 5).where(F.lit(False))
    assert with_ntile(df, [F.asc("k")], 5, "t").count() == 0


def test_no_single_partition_exchange_over_rows(spark):
    # Only the per-partition summary (bounded by the partition count) may be
    # gathered in one task; the rows themselves never are.
    df = _data(spark, 50)
    out = with_running_sum(df, [F.desc("v"), F.asc("k")], "v", num_partitions=4)
    plan_windowed = df.select(F.sum("v").over(Window.orderBy("k")))
    assert single_partition_exchanges(plan_windowed) >= 1
    # what such an exchange reads is the summary: an aggregate by partition id
    nodes = physical_plan(out).splitlines()
    gathered = [i for i, line in enumerate(nodes) if "SinglePartition" in line]
    assert gathered
    for i in gathered:
        assert "HashAggregate(keys=[_ord_pid" in nodes[i + 1], nodes[i:i + 3]
    assert "MapInPandas" not in physical_plan(out)


def test_null_group_is_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), ("a", 5)], "g string, v int")
    got = sorted((r.g or "", r.v, r._cum, r._total) for r in
                 ordered_stats(df, [F.asc("v")], ["g"], sum_col="v", num_partitions=2).collect())
    assert got == [("", 1, 1, 6), ("", 2, 3, 6), ("", 3, 6, 6), ("a", 5, 5, 5)]


def test_double_sums(spark):
    df = spark.createDataFrame([(i, i / 4) for i in range(40)], "k int, v double")
    got = {r.k: r._cum for r in with_running_sum(df, [F.asc("k")], "v", num_partitions=3).collect()}
    assert got == {i: sum(j / 4 for j in range(i + 1)) for i in range(40)}


def test_pinned_tables_are_deleted(spark):
    import os
    from ledgerlens.session import ensure_checkpoint_dir
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    with_ntile(spark.range(20).withColumnRenamed("id", "k"), [F.asc("k")], 5, "t").count()
    assert any(n.startswith("ledgerlens-ordered-") for n in os.listdir(root))
    pinned.release()
    assert not any(n.startswith("ledgerlens-ordered-") for n in os.listdir(root))


def test_heavy_tie_is_split_across_partitions(spark):
    # Every row has the same measure: the key in the order lets the range
    # partitioning split them (by the measure alone they share one task).
    df = spark.range(4000).select(F.col("id").alias("k"), F.lit(D("1.00")).alias("v"))
    def sizes(*order):
        ranged = df.repartitionByRange(8, *order)
        return [r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()]
    assert sizes(F.desc("v")) == [4000]
    with_key = sizes(F.desc("v"), F.asc("k"))
    assert len(with_key) == 8 and max(with_key) < 2 * 4000 / 8
    out = with_running_sum(df, [F.desc("v"), F.asc("k")], "v", num_partitions=8)
    assert out.agg(F.max("_cum")).first()[0] == D("4000.00")


def test_running_sum_skips_nulls(spark):
    rows = [(i, None if i % 3 == 0 or i > 40 else D(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, v decimal(18,2)")
    got = {r.k: r._cum for r in with_running_sum(df, [F.asc("k")], "v", num_partitions=4).collect()}
    expect, acc = {}, D(0)
    for k, v in rows:
        acc += v or 0
        expect[k] = acc
    assert got == expect


def test_adaptive_range_partitions(spark):
    # no explicit partition count: AQE may merge neighbouring ranges
    df = _data(spark, 500, seed=9)
    order = [F.desc("v"), F.asc("k")]
    got = {r.k: r.t for r in with_ntile(df, order, 5, "t").collect()}
    want = {r.k: r.t for r in df.select("k", F.ntile(5).over(Window.orderBy(*order)).alias("t")).collect()}
    assert got == want
