"""Tile borders and cutoffs by counting, against the window functions."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import physical_plan
from ledgerlens import pinned
from ledgerlens.operators import ordered, selection
from ledgerlens.operators.selection import tile_ends, with_running_sum_within, with_tiles
from ledgerlens.plans.registry import QUERIES


@pytest.fixture
def enough(monkeypatch):
    """Few bins and rows to fetch, so that small tables take several rounds."""
    monkeypatch.setattr(selection, "BINS", 31)
    monkeypatch.setattr(selection, "ENOUGH", 20)


def rows(seed, n, values):
    rng = random.Random(seed)
    keys = rng.sample(range(-10 * n, 10 * n), n)
    return [(k, rng.choice(values)) for k in keys]


SPREADS = {
    "spread": [Decimal(x).scaleb(-4) for x in random.Random(1).sample(range(-10 ** 12, 10 ** 12), 400)],
    "tied": [Decimal("1.0000"), Decimal("2.0000"), Decimal("-3.5000")],
    "one": [Decimal("7.0000")],
    "nulls": [None, Decimal("1.2500"), Decimal("9.0000"), None],
    "only nulls": [None],
    "wide": [Decimal("99999999999999999.9999"), Decimal("-99999999999999999.9999"), Decimal("0.0001"), Decimal("0.0000")],
}


@pytest.mark.parametrize("values", SPREADS)
@pytest.mark.parametrize("n,tiles", [(499, 5), (3, 5)])
def test_tiles_equal_ntile(spark, enough, values, n, tiles):
    df = spark.createDataFrame(rows(n, n, SPREADS[values]), "k long, v decimal(21,4)").coalesce(2)
    up, down = ((F.ntile(tiles).over(Window.orderBy(o, F.asc("k")))) for o in (F.asc("v"), F.desc("v")))
    want = sorted(map(tuple, df.select("k", up, down).collect()))
    got = with_tiles(df, "k", {"up": ("v", False), "down": ("v", True)}, tiles).select("k", "up", "down")
    assert sorted(map(tuple, got.collect())) == want


def test_tiles_of_no_rows(spark):
    assert with_tiles(spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("v")), "k", {"t": ("v", True)}, 5).count() == 0


def test_several_orderings_at_once(spark, enough):
    rng = random.Random(4)
    df = spark.createDataFrame([(k, rng.randint(0, 3), rng.randint(-9, 9), Decimal(rng.randint(0, 10 ** 6)).scaleb(-2))
                                for k in range(800)], "k int, a int, b long, c decimal(12,2)")
    orders = {"ta": ("a", True), "tb": ("b", False), "tc": ("c", True)}
    got = with_tiles(df, "k", orders, 5)
    want = df
    for name, (c, descends) in orders.items():
        want = want.withColumn(name, F.ntile(5).over(Window.orderBy(F.desc(c) if descends else F.asc(c), F.asc("k"))))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_other_types_are_sorted(spark):
    df = spark.createDataFrame([(f"k{i}", float(i % 7)) for i in range(50)], "k string, v double")
    want = {r.k: r.t for r in df.withColumn("t", F.ntile(4).over(Window.orderBy(F.desc("v"), F.asc("k")))).collect()}
    assert {r.k: r.t for r in with_tiles(df, "k", {"t": ("v", True)}, 4).collect()} == want


def test_tile_ends():
    assert tile_ends(11, 5) == [3, 5, 7, 9] and tile_ends(3, 5) == [1, 2] and tile_ends(0, 5) == [] and tile_ends(5, 1) == []


GAINS = [Decimal(x).scaleb(-2) for x in random.Random(2).sample(range(1, 10 ** 8), 300)]
SUMS = {"gains": GAINS, "equal gains": [Decimal("2.50")], "mixed": GAINS + [-x for x in GAINS[::2]], "losses": [-x for x in GAINS],
        "equal losses": [Decimal("-1.00")], "mostly losses": GAINS[:60] + [-x for x in GAINS], "nothing": [Decimal("0.00"), None],
        "with nulls": [None, Decimal("3.00"), Decimal("-1.00"), Decimal("0.00")]}


@pytest.mark.parametrize("values", SUMS)
@pytest.mark.parametrize("cutoff", ["0.8", "0"])
def test_running_sum_within_equals_the_window(spark, enough, values, cutoff):
    _check_sums(spark, values, cutoff)


@pytest.mark.parametrize("values,cutoff", [("mixed", "1"), ("gains", "0.999"), ("mostly losses", "1.5")])
def test_shares_near_and_beyond_the_whole(spark, enough, values, cutoff):
    _check_sums(spark, values, cutoff)


def _check_sums(spark, values, cutoff):
    df = spark.createDataFrame(rows(3, 300, SUMS[values]), "k long, v decimal(20,2)").coalesce(2)
    w = Window.orderBy(F.desc("v"), F.asc("k")).rowsBetween(Window.unboundedPreceding, 0)
    cum, total = F.sum(F.coalesce("v", F.lit(0))).over(w), F.sum("v").over(Window.partitionBy())
    share = total * F.lit(Decimal(cutoff))
    want = (df.select("k", "v", cum.alias("c"), total.alias("t"), share.alias("s"))
            .where("(t > 0 and c <= s) or (t < 0 and c >= s)").select("k", "v", "c", "t"))
    got = with_running_sum_within(df, "k", "v", cutoff).select("k", "v", "_cum", "_total")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_rounds_do_not_grow_with_the_rows(spark, monkeypatch):
    """A border among 200,000 rows: bins, then a fetch of at most ENOUGH rows."""
    fetched, rounds = [], []
    count, fetch = selection._Rows.count, selection._Rows.fetch
    monkeypatch.setattr(selection._Rows, "count", lambda self, i: (rounds.append(1), count(self, i))[1])
    monkeypatch.setattr(selection._Rows, "fetch", lambda self, i: (lambda r: (fetched.extend(r), r)[1])(fetch(self, i)))
    df = spark.range(200_000).select(F.col("id").alias("k"), (F.xxhash64("id") % 10 ** 9).alias("v"))
    got = with_tiles(df, "k", {"t": ("v", True)}, 5).groupBy("t").agg(F.count("*").alias("n"), F.max("v").alias("high"), F.min("v").alias("low"))
    got = sorted(got.collect())
    assert [r.n for r in got] == [40_000] * 5 and all(a.low >= b.high for a, b in zip(got, got[1:]))
    assert len(rounds) <= 2 and all(len(r) <= selection.ENOUGH for r in fetched)


@pytest.mark.parametrize("name", ["q01_7_top_quintile_revenue_share", "q07_5_rfm", "q07_6_churn_risk", "q08_8_top_revenue_customers_tile"])
def test_tiles_write_once_and_sort_and_join_nothing(spark, sf_small, monkeypatch, name):
    written, pin = [], pinned.pin
    for module in (ordered, selection):
        monkeypatch.setattr(module, "pin", lambda df, n="x": (written.append(n), pin(df, n))[1])
    text = physical_plan(QUERIES[name](spark, sf_small))
    assert written == ["tiled"] and "Window" not in text and "Join" not in text
    ranges = [line for line in text.splitlines() if "rangepartitioning" in line]
    assert all("RFM" in line for line in ranges)              # the result's own ORDER BY


@pytest.mark.parametrize("name", ["q07_7_pareto_products", "q07_8_pareto_customers"])
def test_only_kept_rows_are_sorted(spark, sf_small, monkeypatch, name):
    written, pin = [], ordered.pin
    monkeypatch.setattr(ordered, "pin", lambda df, n="x": (lambda out: (written.append(out.count()), out)[1])(pin(df, n)))
    assert QUERIES[name](spark, sf_small).count() == written[0] and len(written) == 1
