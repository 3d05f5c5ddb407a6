"""Row numbers, n-tiles, ranks and running sums over a total order.

``NTILE() OVER (ORDER BY x)`` and ``SUM(x) OVER (ORDER BY x ROWS UNBOUNDED
PRECEDING)`` with no PARTITION BY make Spark move every row into one task
(``Exchange SinglePartition``).  Over customers or products that task grows
with the data.  ``ordered_stats`` computes the same values in parallel:

1. range-partition the rows on the ordering (Spark samples the keys, so a
   heavy value of the first key is split by the remaining keys; AQE may merge
   neighbouring small ranges) and sort each partition;
2. number the rows of each partition (``monotonically_increasing_id``) and
   write them as a Parquet table in the session's checkpoint folder: the
   lineage is cut, both readers below see exactly the same rows, also after
   executor loss, and since partition id and row id are stored as columns
   nothing depends on how the table is read back.  This part runs when the
   operator is called, not when its result is used;
3. aggregate one row per (partition, group): count, first row id, sum --
   a read of just those columns; prefix-sum these few rows in partition
   order to get each partition's offsets; join them back;
4. a running sum is a window over each range partition plus its offset.

The only single-task step is the prefix sum over the per-partition summary,
whose size is bounded by the number of partitions (plus groups).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..pinned import pin

_PID, _IDX = "_ord_pid", "_ord_idx"


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def ordered_stats(df: DataFrame, order_by: Sequence[Column], partition_by: Sequence[str] = (),
                  sum_col: str | None = None, num_partitions: int | None = None,
                  keep_partition: bool = False) -> DataFrame:
    """Add ``_rn`` (1-based row number in the order, within ``partition_by``)
    and ``_n`` (rows in the group); with ``sum_col`` also ``_cum`` (running
    sum including the current row) and ``_total`` (group sum).  NULL values
    add nothing to the sums.

    ``order_by`` must be a total order (end it with a key) for results to be
    deterministic, as with the SQL window functions it replaces.
    """
    groups = list(partition_by)
    sort = [F.col(g).asc() for g in groups] + list(order_by)

    # Without an explicit count the range shuffle starts at
    # spark.sql.shuffle.partitions and AQE merges small neighbouring ranges
    # to its advisory size; merged ranges stay in order, and the checkpoint
    # below pins whichever layout the run produced.
    by_range = (df.repartitionByRange(num_partitions, *sort) if num_partitions
                else df.repartitionByRange(*sort))
    ranged = (by_range.sortWithinPartitions(*sort)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_IDX, F.monotonically_increasing_id()))
    pinned = pin(ranged, "ordered")

    aggs = [F.count(F.lit(1)).alias("_cnt"), F.min(_IDX).alias("_first")]
    if sum_col is not None:
        aggs.append(F.sum(F.coalesce(F.col(sum_col), F.lit(0))).alias("_psum"))
    stats = pinned.groupBy(_PID, *groups).agg(*aggs)
    in_order = Window.partitionBy(*groups).orderBy(_PID)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    cols = [_PID, *groups, "_first",
            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
            F.sum("_cnt").over(whole).alias("_n")]
    if sum_col is not None:
        cols += [F.coalesce(F.sum("_psum").over(before), F.lit(0)).alias("_off_sum"),
                 F.sum("_psum").over(whole).alias("_total")]
    offsets = stats.select(*cols)

    if groups:
        joined = _null_safe_join(pinned, offsets, [_PID, *groups])
    else:
        joined = pinned.join(offsets, _PID)
    out = joined.withColumn("_rn", F.col("_off") + F.col(_IDX) - F.col("_first") + F.lit(1))
    if sum_col is not None:
        # within a range partition, then what came before it
        local = Window.partitionBy(_PID, *groups).orderBy(_IDX).rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn("_cum", F.col("_off_sum") + F.sum(F.coalesce(F.col(sum_col), F.lit(0))).over(local))
    keep = [c for c in df.columns] + ([_PID] if keep_partition else []) + ["_rn", "_n"] + (["_cum", "_total"] if sum_col else [])
    return out.select(*keep)


def ntile_from_position(rn: Column, n: Column, tiles: int) -> Column:
    """NTILE(tiles) of the row at 1-based position ``rn`` among ``n`` rows:
    the first ``n % tiles`` tiles hold one row more than the others."""
    b = F.floor(n / F.lit(tiles)).cast("long")
    r = (n % F.lit(tiles)).cast("long")
    big = r * (b + F.lit(1))
    return (F.when(b == 0, rn)
            .when(rn <= big, F.floor((rn - F.lit(1)) / (b + F.lit(1))) + F.lit(1))
            .otherwise(F.floor((rn - F.lit(1) - r) / b) + F.lit(1))).cast("int")


def with_ntile(df: DataFrame, order_by: Sequence[Column], tiles: int, name: str,
               num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``NTILE(tiles) OVER (ORDER BY order_by)`` as ``name``."""
    s = ordered_stats(df, order_by, num_partitions=num_partitions)
    return (s.withColumn(name, ntile_from_position(F.col("_rn"), F.col("_n"), tiles))
            .drop("_rn", "_n"))


def with_ntiles(df: DataFrame, key: str, orders: dict[str, tuple[str, bool]], tiles: int,
                num_partitions: int | None = None) -> DataFrame:
    """``df`` plus one NTILE column per entry of ``orders`` (name: column and
    whether it descends; ties by the unique ``key``).  ``df`` is written once;
    each ordering shuffles only the key and its column, and the tiles are
    joined on the key."""
    base = pin(df, "tiled")
    out = base
    for name, (column, descends) in orders.items():
        narrow = base.select(F.col(key).alias("_k"), F.col(column).alias("_v"))
        order = [F.desc("_v") if descends else F.asc("_v"), F.asc("_k")]
        tiled = with_ntile(narrow, order, tiles, name, num_partitions)
        out = out.join(tiled.select(F.col("_k").alias(key), name), key)
    return out


def with_running_sum(df: DataFrame, order_by: Sequence[Column], value: str,
                     num_partitions: int | None = None) -> DataFrame:
    """``df`` plus ``_cum`` (running sum of ``value`` in ``order_by``, ROWS
    frame) and ``_total`` (sum over all rows)."""
    s = ordered_stats(df, order_by, sum_col=value, num_partitions=num_partitions)
    return s.drop("_rn", "_n")


def with_rank(df: DataFrame, partition_by: Sequence[str], value: str, name: str,
              tie_break: Sequence[str], descending: bool = True,
              num_partitions: int | None = None) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition_by ORDER BY value)``.

    The rows are numbered in (value, tie_break) order with ``ordered_stats``,
    which splits a large group over many tasks; a row's rank is the smallest
    row number among the rows sharing its value (1 + rows strictly before),
    which does not depend on how ties are ordered.  ``tie_break`` columns make
    the order total so range partitioning can split a heavily tied value; the
    smallest number is found per (range partition, value) and then over the
    few partitions a value spans, so a tie is never one join key.
    Both readers of the numbered rows read the pinned table, so the input is
    computed once.
    """
    groups = list(partition_by)
    v = F.col(value)
    order = [v.desc_nulls_last() if descending else v.asc_nulls_first()]
    order += [F.col(c).asc() for c in tie_break]
    numbered = ordered_stats(df, order, groups, num_partitions=num_partitions, keep_partition=True)
    here = numbered.groupBy(_PID, *groups, value).agg(F.min("_rn").alias("_low"))
    first = here.select(_PID, *groups, value, F.min("_low").over(Window.partitionBy(*groups, value)).cast("long").alias(name))
    return _null_safe_join(numbered.drop("_rn", "_n"), first, [_PID, *groups, value]).drop(_PID)
