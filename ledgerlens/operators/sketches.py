"""Mergeable distinct counts: sketches per key and period, rolled up later.

``COUNT(DISTINCT)`` over years cannot be added up from months, so each report
over another period reads the facts again.  A sketch (HyperLogLog of the
DataSketches library, built into Spark) can: ``distinct_sketches`` folds the
facts once to one small binary per key and period, to be stored; ``roll_up``
merges them to coarser keys or periods and ``distinct_estimate`` reads them.

Exact counts stay the operators' own way; this is for those who ask for it.
With ``lg_k`` bits the relative standard error is about 1.04 / sqrt(2**lg_k),
0.8 % for the default of 14, and a sketch takes at most about 2**lg_k bytes.
Estimates of few values (under about a tenth of 2**lg_k) are nearly exact.
Nulls are not counted, as with COUNT(DISTINCT).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 14


def _as_key(column: Column, kind: str) -> Column:
    # the sketch takes whole numbers, strings and binaries
    return column.cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else column.cast("string")


def distinct_sketches(facts: DataFrame, column: str, keys: Sequence[str | Column], lg_k: int = LG_K) -> DataFrame:
    """One row per combination of ``keys``: ``Sketch`` of the distinct values of
    ``column``, and ``Lines``, the number of rows."""
    value = _as_key(F.col(column), facts.schema[column].dataType.simpleString())
    return facts.groupBy(*keys).agg(F.hll_sketch_agg(value, F.lit(lg_k)).alias("Sketch"), F.count(F.lit(1)).alias("Lines"))


def roll_up(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches merged to coarser ``keys``; rows of several stores may be united
    first, also with values counted in both."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("Sketch", F.lit(True)).alias("Sketch"), F.sum("Lines").alias("Lines"))


def distinct_estimate(sketches: DataFrame, name: str = "Distinct") -> DataFrame:
    """The sketch column replaced by its estimate."""
    return sketches.withColumn(name, F.hll_sketch_estimate("Sketch")).drop("Sketch")


def error_bound(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that an estimate keeps within, at so many standard deviations."""
    return deviations * 1.04 / 2 ** (lg_k / 2)
