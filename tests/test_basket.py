"""Co-occurrence counts equal a brute-force self-join, with and without salting."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.basket import co_occurrence, named_co_occurrence
from ledgerlens.operators.products import products_bought_together


def _brute(lines, distinct):
    by_basket = {}
    for b, i in lines:
        by_basket.setdefault(b, []).append(i)
    out = Counter()
    for b, items in by_basket.items():
        pairs = Counter()
        for x, y in itertools.product(items, items):
            if x > y:
                pairs[(x, y)] += 1
        for p, c in pairs.items():
            out[p] += 1 if distinct else c
    return dict(out)


def _lines(seed):
    rnd = random.Random(seed)
    lines = [(rnd.randrange(30), rnd.randrange(12)) for _ in range(400)]
    lines += [(999, rnd.randrange(40)) for _ in range(300)]     # one hot basket
    lines += [(5, 3), (5, 3), (5, 4)]                            # repeated item
    return lines


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("pairs_per_task", [5_000_000, 50])     # 50 forces salting
def test_pairs_equal_brute_force(spark, distinct, pairs_per_task):
    lines = _lines(1)
    df = spark.createDataFrame(lines, "basket long, item long")
    got = {(r.item_a, r.item_b): r.pairs for r in
           co_occurrence(df, "basket", "item", distinct, pairs_per_task=pairs_per_task).collect()}
    assert got == _brute(lines, distinct)


def test_line_multiplicity(spark):
    df = spark.createDataFrame([(1, 7), (1, 7), (1, 3), (1, 3), (1, 3)], "basket long, item long")
    got = {(r.item_a, r.item_b): r.pairs for r in co_occurrence(df, "basket", "item").collect()}
    assert got == {(7, 3): 6}


@pytest.mark.parametrize("hot", [0, 120])                        # 120 distinct items: 7,140 pairs of one basket
def test_tasks_follow_the_pairs_not_the_bytes(spark, hot):
    lines = [(b, b * 10 + i) for b in range(400) for i in range(10)] + [(-1, i) for i in range(hot)]
    df = spark.createDataFrame(lines, "basket long, item long")
    pairs = co_occurrence(df, "basket", "item", pairs_per_task=1000)
    held = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == len(_brute(lines, False)) and max(held) < 2000


def test_lines_of_a_hot_basket_in_many_files(spark):
    lines = [(1, i % 3) for i in range(900)] + [(1, None), (None, 1)]
    df = spark.createDataFrame(lines, "basket long, item long").repartition(80)
    for distinct, n in ((False, 300 * 300), (True, 1)):
        got = {(r.item_a, r.item_b): r.pairs for r in co_occurrence(df, "basket", "item", distinct).collect()}
        assert got == {(1, 0): n, (2, 0): n, (2, 1): n}


def test_no_lines(spark):
    assert co_occurrence(spark.createDataFrame([], "basket long, item long"), "basket", "item").collect() == []


def _named(spark, lines, names, **sizes):
    lines = spark.createDataFrame(lines, "basket long, item long")
    return named_co_occurrence(lines, spark.createDataFrame(names, "item long, name string"), "basket", "item", "name", **sizes)


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("per_task", [1_000_000, 20])
def test_named_pairs_equal_brute_force(spark, distinct, per_task):
    lines = _lines(2)
    # names of several items, an item twice, a null name, a null item, an item without a name (11)
    names = [(i, f"n{i // 3}") for i in range(40) if i not in (7, 11)] + [(7, None), (None, "x"), (3, "again")]
    want = Counter()
    for (a, b), n in _brute(lines, distinct).items():
        for name_a, name_b in itertools.product([m for i, m in names if i == a], [m for i, m in names if i == b]):
            want[(name_a, name_b)] += n
    got = [tuple(r) for r in _named(spark, lines, names, distinct_baskets=distinct, pairs_per_task=per_task, lines_per_task=per_task).collect()]
    assert {r[:2]: r[2] for r in got} == want and len(got) == len(want)
    assert got == sorted(got, key=lambda r: (-r[2], r[0] or "", r[1] or ""))


def test_named_pairs_are_dealt_by_their_number(spark):
    lines = [(b, b * 10 + i) for b in range(400) for i in range(10)]                # 18,000 pairs, 4 shuffle partitions
    named = _named(spark, lines, [(i, f"name {i}") for i in range(4000)], pairs_per_task=1000)
    held = [r["count"] for r in named.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 18_000 and max(held) < 2000


def test_names_get_tasks_where_pairs_are_few(spark):
    plan = _named(spark, [(1, 1), (1, 2)], [(i, f"name {i}") for i in range(2000)], lines_per_task=200)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item_a" in plan and plan.count(", 10), ") >= 6     # joins, fold and sort: 2,000 names by 200


def test_only_names_are_dealt_by_the_session(spark):
    detail = spark.createDataFrame([(1, 1), (1, 2)], "SalesOrderID long, ProductID long")
    product = spark.createDataFrame([(1, "a"), (2, "b")], "ProductID long, Name string")
    for distinct in (False, True):
        plan = products_bought_together(detail, product, distinct)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ENSURE_REQUIREMENTS") == 2 and plan.count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plan
