"""Tile borders and cutoffs in a total order, found by counting.

``NTILE`` needs the few rows at the tiles' ends, a running sum with a cutoff
the one row that crosses it; neither needs the others sorted.  Rows are
counted (or their values summed) in ``BINS`` equal bins of an interval of the
ordered column, the bin that holds the wanted row becomes the next interval,
and so on until it holds at most ``ENOUGH`` rows, which are fetched, or a
single value, whose rows are told apart by their key in the same way.  A round
is one scan with map-side aggregation: what is shuffled is a row per task and
bin, and the driver gets bins and at most ``ENOUGH`` rows per border.  All
borders of all orderings share the rounds; their number grows with the
logarithm of the value range, to base ``BINS``, whatever the row count.

Bins are cut in whole units of the column (exact decimals and whole numbers),
so no border depends on rounding.  Tiles are then comparisons with literals:
no sort, no exchange, no join.

The rows are written once, in the checkpoint folder: rounds and result read
what was folded from the facts instead of folding them again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Context, Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..pinned import pin
from .ordered import with_ntiles, with_running_sum

BINS = 1024
ENOUGH = 16_384
_EXACT = Context(prec=80)


def _scale(data_type: T.DataType) -> int | None:
    """Decimal places of an exact type, None for others."""
    if isinstance(data_type, T.DecimalType):
        return data_type.scale
    return 0 if isinstance(data_type, T.IntegralType) else None


def exact(df: DataFrame, *columns: str) -> bool:
    return all(_scale(df.schema[c].dataType) is not None for c in columns)


def _units(value, scale: int) -> int:
    """A collected value in units of 10**-scale."""
    return int(_EXACT.scaleb(Decimal(value), scale))


def _lit(units: int, scale: int) -> Column:
    digits = tuple(int(x) for x in str(abs(units)))
    return F.lit(Decimal((int(units < 0), digits, -scale)))


def _number(column: str, data_type: T.DataType) -> Column:
    return F.col(column).cast("decimal(20,0)") if isinstance(data_type, T.IntegralType) else F.col(column)


@dataclass
class _Interval:
    """Rows with ``low`` <= y <= ``high`` of one ordering, or (``tie`` set) with
    y = ``tie`` and a key in the interval; ``before`` stands ahead of them."""
    y: str
    low: int
    high: int
    before: int = 0
    rows: int = 0
    tie: int | None = None

    @property
    def place(self):
        return self.y, self.low, self.high, self.tie

    @property
    def width(self) -> int:
        return -(-(self.high - self.low + 1) // BINS)


class _Rows:
    """Of a written table the key ``k`` and, per ordering, ``y`` columns whose
    ascending order (nulls placed) is the wanted order."""

    def __init__(self, df: DataFrame, key: str, orders: dict[str, tuple[str, bool]], *more: Column):
        kinds = {c: df.schema[c].dataType for c in {key, *(c for c, _ in orders.values())}}
        self.scales = {"k": _scale(kinds[key]), **{f"y_{name}": _scale(kinds[c]) for name, (c, _) in orders.items()}}
        columns = [_number(key, kinds[key]).alias("k")]
        for name, (c, descends) in orders.items():
            number = _number(c, kinds[c])
            columns.append((-number if descends else number).alias(f"y_{name}"))
        self.plain = dict(zip(self.scales, columns))
        self.nulls_last = {f"y_{name}": descends for name, (_, descends) in orders.items()} | {"k": False}
        self.rows = df.select(*columns)
        ends = [f(c).alias(f"{c}_{f.__name__}") for c in self.scales for f in (F.min, F.max)]
        found = self.rows.agg(F.count(F.lit(1)).alias("n"), *ends, *more)
        self.schema, r = found.schema, found.first()
        self.found, self.n = r, r.n
        self.common = max(s for c, s in self.scales.items() if c != "k")
        self.range, self.known, self.at_null = {}, {}, {}         # with and without the place of nulls
        for c, s in self.scales.items():
            low, high = (0, 0) if r[f"{c}_min"] is None else (_units(r[f"{c}_min"], s), _units(r[f"{c}_max"], s))
            self.at_null[c] = high + 1 if self.nulls_last[c] else low - 1
            self.known[c] = low, high
            self.range[c] = min(low, self.at_null[c]), max(high, self.at_null[c])

    def column(self, c: str, plain: bool = False) -> Column:
        """``c`` with nulls in their place; ``plain``: over the caller's own columns."""
        return F.coalesce(self.plain[c] if plain else F.col(c), self.lit(c, self.at_null[c]))

    def lit(self, c: str, units: int) -> Column:
        return _lit(units, self.scales[c])

    def _shared(self, y: str) -> Column:
        """y in the one type that rows of all orderings share."""
        return self.column(y).cast(f"decimal(38,{self.common})").alias("y")

    def _own(self, value, y: str) -> int:
        return _units(value, self.common) // 10 ** (self.common - self.scales[y])

    def inside(self, i: _Interval) -> Column:
        c = i.y if i.tie is None else "k"
        between = self.column(c).between(self.lit(c, i.low), self.lit(c, i.high))
        return between if i.tie is None else (self.column(i.y) == self.lit(i.y, i.tie)) & between

    def _in_slots(self, intervals: Sequence[_Interval], fields) -> DataFrame:
        cases = [F.when(self.inside(i), F.struct(F.lit(s).alias("slot"), *fields(i))) for s, i in enumerate(intervals)]
        return self.rows.select(F.explode(F.array_compact(F.array(*cases))).alias("e")).select("e.*")

    def count(self, intervals: Sequence[_Interval]) -> list[dict[int, tuple[int, int]]]:
        """Per interval and bin: rows, and the sum of y in units."""
        def fields(i):
            c = i.y if i.tie is None else "k"
            units = F.call_function("div", self.column(c) - self.lit(c, i.low), self.lit(c, i.width))
            return units.alias("bin"), self._shared(i.y)

        out = [{} for _ in intervals]
        for r in self._in_slots(intervals, fields).groupBy("slot", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect():
            out[r.slot][r.bin] = r.n, self._own(r.s, intervals[r.slot].y)
        return out

    def fetch(self, intervals: Sequence[_Interval]) -> list[list[tuple[int, int]]]:
        """The (y, k) of every row of the intervals, in order."""
        out = [[] for _ in intervals]
        rows = self._in_slots(intervals, lambda i: (self._shared(i.y), self.column("k").alias("k"))).toArrow()
        for slot, y, k in zip(*(rows[c].to_pylist() for c in ("slot", "y", "k"))):
            out[slot].append((self._own(y, intervals[slot].y), _units(k, self.scales["k"])))
        return [sorted(rows) for rows in out]

    def whole(self, y: str) -> _Interval:
        return _Interval(y, *self.range[y], rows=self.n)

    def narrowed(self, i: _Interval, b: int, before: int, rows: int) -> _Interval:
        low = i.low + b * i.width
        high = min(i.high, low + i.width - 1)
        if i.tie is None and low == high:                    # one value: on by key
            return _Interval(i.y, *self.range["k"], before, rows, low)
        return _Interval(i.y, low, high, before, rows, i.tie)


def _at_ranks(rows: _Rows, targets: list[tuple[int, _Interval]]) -> list[tuple[int, int]]:
    """The (y, k) of the row at each 1-based rank, searched from its interval."""
    found: list = [None] * len(targets)
    ranks, at = [r for r, _ in targets], [i for _, i in targets]
    while True:
        wide = [t for t in range(len(at)) if at[t].rows > ENOUGH and at[t].low < at[t].high]
        if not wide:
            break
        distinct = list({at[t].place: at[t] for t in wide}.values())
        counts = dict(zip((i.place for i in distinct), rows.count(distinct)))
        for t in wide:
            before, here = at[t].before, counts[at[t].place]
            for b in sorted(here):
                if before + here[b][0] >= ranks[t]:
                    at[t] = rows.narrowed(at[t], b, before, here[b][0])
                    break
                before += here[b][0]
    few = list({i.place: i for i in at if i.rows <= ENOUGH}.values())
    fetched = dict(zip((i.place for i in few), rows.fetch(few) if few else []))
    for t, i in enumerate(at):
        found[t] = fetched[i.place][ranks[t] - i.before - 1] if i.place in fetched else (i.tie, i.low)
    return found


def _after(rows: _Rows, y: str, border: tuple[int, int], plain: bool = True) -> Column:
    """Whether a row comes after the border row."""
    v, k = rows.column(y, plain), rows.column("k", plain)
    at, key = rows.lit(y, border[0]), rows.lit("k", border[1])
    return (v > at) | ((v == at) & (k > key))


def tile_ends(n: int, tiles: int) -> list[int]:
    """Rank of the last row of each tile that others follow (the first
    ``n % tiles`` tiles hold one row more)."""
    ends = [t * (n // tiles) + min(t, n % tiles) for t in range(1, tiles)]
    return [e for e in ends if e < n]


def with_tiles(df: DataFrame, key: str, orders: dict[str, tuple[str, bool]], tiles: int) -> DataFrame:
    """``df`` plus one NTILE column per entry of ``orders`` (name: column and
    whether it descends; ties by ``key``, which is to be unique; nulls come
    first, in a descending order last).  Columns of other types than whole
    numbers and decimals go the way of sorting (``with_ntiles``)."""
    if not exact(df, key, *(c for c, _ in orders.values())):
        return with_ntiles(df, key, orders, tiles)
    df = pin(df, "tiled")
    rows = _Rows(df, key, orders)
    ends = tile_ends(rows.n, tiles)
    names = [(name, e) for name in orders for e in ends]
    borders = _at_ranks(rows, [(e, rows.whole(f"y_{name}")) for name, e in names])
    out = df
    for name in orders:
        tile = F.lit(1)
        for (of, _), border in zip(names, borders):
            if of == name:
                tile = tile + _after(rows, f"y_{name}", border).cast("int")
        out = out.withColumn(name, tile)
    return out


def _crossing(rows: _Rows, y: str, sign: int, limit: Fraction) -> tuple[int, int]:
    """The first row, in order, at which the sum of sign * y over the rows with
    sign * y > 0 exceeds ``limit`` (in units)."""
    low, high = rows.known[y]
    i = _Interval(y, max(low, 1), high, rows=rows.n) if sign > 0 else _Interval(y, low, min(high, -1), rows=rows.n)
    total = 0
    while i.tie is None and i.rows > ENOUGH:
        here = rows.count([i])[0]
        for b in sorted(here):
            if total + sign * here[b][1] > limit:
                i = rows.narrowed(i, b, 0, here[b][0])
                break
            total += sign * here[b][1]
    if i.tie is not None:                                    # equal values: by how many of them
        rank = int((limit - total) // abs(i.tie)) + 1
        return _at_ranks(rows, [(rank, i)])[0]
    for value, k in rows.fetch([i])[0]:
        total += sign * value
        if total > limit:
            return value, k
    raise AssertionError("the sum stays within the limit")


def with_running_sum_within(df: DataFrame, key: str, value: str, cutoff: Decimal | str) -> DataFrame:
    """The rows of ``df``, by descending ``value`` (ties by the unique ``key``),
    whose running sum is within ``cutoff`` of the total (at least that much of
    a negative total; none of a total of zero), plus ``_cum`` and ``_total``.

    For a cutoff below 1 these are the first rows up to the one that crosses
    it: only they are sorted.  Beyond that, and for other types than decimals
    and whole numbers, all rows are."""
    share = Decimal(str(cutoff))
    if not (0 <= share < 1 and exact(df, key, value)):
        ranked = with_running_sum(df, [F.desc(value), F.asc(key)], value)
        limit = F.col("_total") * F.lit(share)
        return ranked.where(F.when(F.col("_total") > 0, F.col("_cum") <= limit).when(F.col("_total") < 0, F.col("_cum") >= limit))
    df = pin(df, "cutoff")
    v = F.col("y_v")
    rows = _Rows(df, key, {"v": (value, True)}, F.sum(-v).alias("total"), F.sum(F.when(v < 0, -v)).alias("gains"))
    r, scale, total_type = rows.found, rows.scales["y_v"], rows.schema["total"].dataType
    total = 0 if r.total is None else _units(r.total, scale)
    kept = df.where(F.lit(False))
    if total:
        gains = 0 if r.gains is None else _units(r.gains, scale)
        # the sum rises over the positive values and falls over the negative ones: a positive
        # total's share is crossed on the way up, a negative total's on the way down
        sign, limit = (-1, total * Fraction(share)) if total > 0 else (1, gains - total * Fraction(share))
        border = _crossing(rows, "y_v", sign, limit)
        kept = df.where(~(_after(rows, "y_v", border) | ((rows.column("y_v", True) == rows.lit("y_v", border[0]))
                                                         & (rows.column("k", True) == rows.lit("k", border[1])))))
    return with_running_sum(kept, [F.desc(value), F.asc(key)], value).withColumn("_total", _lit(total, scale).cast(total_type))
