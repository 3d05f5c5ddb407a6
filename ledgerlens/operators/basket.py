"""Item co-occurrence within baskets ("frequently bought together").

A self-join of lines on the basket key is quadratic per basket, reads the
lines twice and puts a hot basket (one order holding a large share of all
lines) into one task.  ``co_occurrence`` makes the pairs inside the baskets,
there is no second side.  A task's memory follows the rows it folds, and those
are many more than the bytes it reads (a basket of k items is k*(k-1)/2
pairs), so tasks are not sized by bytes: the lines per basket are counted
first, and every fold gets as many tasks as its lines and pairs need.

1. lines are dealt by (basket, item, share) and folded with the line count;
   shares are those of the scan's tasks, ``SHARES`` at most.  A hot basket
   arrives at step 2 as its distinct items, once per share;
2. those rows are gathered to one array per basket, sorted by item, and cut
   into ranges, so that two of them make about ``pairs_per_task`` pairs.  The
   triangle of pairs (a > b) of a basket becomes pairs of ranges; a basket of
   one range is one of them;
3. range pairs of baskets with several ranges are dealt over tasks by their
   number of pairs (an item is copied once per range of its basket), the
   others stay where they are;
4. each row of items meets the smaller items of the other range, streaming,
   and ``count_a * count_b`` is summed per item pair, first in the task
   (per bucket of baskets), then over all.

An array holds distinct items of one basket: at most the number of products.
Only ids travel; ``named_co_occurrence`` joins names to the folded pairs.  Its
joins, folds and sort get their tasks from the same counts; the session's
shuffle partitions can only add to them.  The names are the hashed side of
the joins, the pairs stream past them and are never sorted by id.

Line multiplicity is kept: two lines of item A and three of item B in one
basket give 6 line pairs, exactly as the line-level self-join counts them.
With ``distinct_baskets=True`` each basket counts once per pair instead.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import MAX_SHUFFLE_PARTITIONS

SHARES = 64                 # rows an item of a hot basket is folded to, at most
BUCKETS_PER_TASK = 64       # evens out how buckets fall on tasks


def _pairs(ranges: DataFrame) -> DataFrame:
    """``n`` summed by (bucket, item_a, item_b) with item_a > item_b, from each
    row's two ranges (the same one, or all of ``upper`` above all of ``lower``)."""
    above = ranges.select("bucket", "same", "lower", F.posexplode("upper").alias("pos", "a"))
    below = F.when(F.col("same"), F.slice("lower", 1, F.col("pos"))).otherwise(F.col("lower"))
    return (above.select("bucket", "a", F.explode(below).alias("b"))
            .select("bucket", F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b"), (F.col("a.n") * F.col("b.n")).alias("n"))
            .groupBy("bucket", "item_a", "item_b").agg(F.sum("n").alias("n")))


def _tasks(need: float) -> int:
    return max(1, min(MAX_SHUFFLE_PARTITIONS, math.ceil(need)))


def _bucket(tasks: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(tasks * BUCKETS_PER_TASK))


def _sizes(lines: DataFrame, size: int) -> tuple[int, float, float]:
    """Lines, pairs in baskets of up to ``size`` lines (as if no item came
    twice), and pairs of distinct items in the wider ones."""
    made = F.col("k").cast("double") * (F.col("k") - 1) / 2
    per = lines.groupBy("basket").agg(F.count(F.lit(1)).alias("k"))
    of = per.agg(F.sum("k").alias("lines"), F.sum(F.when(F.col("k") <= size, made)).alias("narrow"), F.max("k").alias("widest")).first()
    wide = 0.0
    if (of.widest or 0) > size:
        items = (lines.join(per.where(F.col("k") > size).select("basket"), "basket", "left_semi").distinct()
                 .groupBy("basket").agg(F.count(F.lit(1)).alias("k")))
        wide = items.agg(F.sum(made)).first()[0]
    return of.lines or 0, of.narrow or 0.0, wide


def _folded(lines: DataFrame, basket: str, item: str, distinct_baskets: bool,
            pairs_per_task: int, lines_per_task: int) -> tuple[DataFrame, int]:
    """(``item_a``, ``item_b``, ``pairs``) and the tasks they are dealt over."""
    size = max(1, math.isqrt(pairs_per_task))           # items of a range
    lines = (lines.where(F.col(basket).isNotNull() & F.col(item).isNotNull())
             .select(F.col(basket).alias("basket"), F.col(item).alias("item")))
    rows, narrow, wide = _sizes(lines, size)
    tasks = _tasks(max(rows / lines_per_task, narrow / pairs_per_task))

    shares = (lines.withColumn("share", F.spark_partition_id() % SHARES)
              .repartition(tasks, "basket", "item", "share")
              .groupBy("basket", "item", "share").agg(F.count(F.lit(1)).alias("n")))
    count = F.lit(1).cast("long") if distinct_baskets else F.sum("n")
    items = (shares.withColumn("bucket", _bucket(tasks, "basket"))
             .repartition(tasks, "bucket")
             .groupBy("bucket", "basket", "item").agg(count.alias("n"))
             .groupBy("bucket", "basket").agg(F.array_sort(F.collect_list(F.struct("item", "n"))).alias("items")))

    one = items.where(F.size("items") > 1)
    if wide:
        one = one.where(F.size("items") <= size)
    pairs = _pairs(one.select("bucket", F.lit(True).alias("same"), F.col("items").alias("lower"), F.col("items").alias("upper")))
    if wide:
        many = items.where(F.size("items") > size)
        last = F.ceil(F.size("items") / size).cast("int") - 1
        cut = lambda k: F.slice("items", k * size + 1, size)
        many = (many.select("basket", "items", F.explode(F.sequence(F.lit(0), last)).alias("i"))
                .select("basket", "items", "i", F.explode(F.sequence(F.lit(0), F.col("i"))).alias("j"))
                .select((F.col("i") == F.col("j")).alias("same"), cut(F.col("j")).alias("lower"), cut(F.col("i")).alias("upper"),
                        _bucket(_tasks(wide / pairs_per_task), "basket", "i", "j").alias("bucket")))
        pairs = pairs.unionByName(_pairs(many.repartition(_tasks(wide / pairs_per_task), "bucket")))

    tasks = _tasks((narrow + wide) / pairs_per_task)
    return pairs.repartition(tasks, "item_a", "item_b").groupBy("item_a", "item_b").agg(F.sum("n").alias("pairs")), tasks


def co_occurrence(lines: DataFrame, basket: str, item: str, distinct_baskets: bool = False,
                  pairs_per_task: int = 1_000_000, lines_per_task: int = 500_000) -> DataFrame:
    """Return (``item_a``, ``item_b``, ``pairs``) for item_a > item_b."""
    return _folded(lines, basket, item, distinct_baskets, pairs_per_task, lines_per_task)[0]


def named_co_occurrence(lines: DataFrame, names: DataFrame, basket: str, item: str, name: str, distinct_baskets: bool = False,
                        pairs_per_task: int = 1_000_000, lines_per_task: int = 500_000) -> DataFrame:
    """Return (``name_a``, ``name_b``, ``pairs``), most pairs first, then by name:
    the item pairs added up by the ``name`` that ``names`` has for each ``item``.

    The first fold by name is one per smaller item, in the task that joined it
    (at most a row per product), so that names of many items meet folded."""
    pairs, tasks = _folded(lines, basket, item, distinct_baskets, pairs_per_task, lines_per_task)
    session = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, min(session, 10 * tasks), _tasks(names.count() / lines_per_task))

    def named(side: str) -> DataFrame:
        return names.select(F.col(item).alias(f"item_{side}"), F.col(name).alias(f"name_{side}")).hint("shuffle_hash")

    order = [F.desc("pairs"), "name_a", "name_b"]
    return (pairs.repartition(tasks, "item_a").join(named("a"), "item_a")
            .repartition(tasks, "item_b").join(named("b"), "item_b")
            .groupBy("item_b", "name_a", "name_b").agg(F.sum("pairs").alias("pairs"))
            .repartition(tasks, "name_a", "name_b")
            .groupBy("name_a", "name_b").agg(F.sum("pairs").alias("pairs"))
            .repartitionByRange(tasks, *order).orderBy(*order))
