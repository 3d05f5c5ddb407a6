"""Document fingerprints by prefix polynomial hashes.

A text's modular prefix array holds the polynomial hash of every prefix, so
the hash of any span is one subtraction and one multiplication: spans are
compared without reading them, and the longest common extension of two
positions is a binary search over lengths.

A fingerprint is read off that array: the length, the hash of the whole text,
the hashes of prefixes at growing lengths, and the smallest hashes of all
16-character spans.  Likeness of two fingerprints is the larger of the shared
prefix's share (binary search over the prefix hashes) and the resemblance of
the span samples.  Beside it stand the lengths of the longest common
extensions from the texts' starts (``common_*``), searched in the arrays.

Cases: null text counts as empty; two empty texts are alike (1), an empty and
another are not (0); null doc_ids come first in the order, equal doc_ids are
ordered by text hash, so repeated rows are neighbours; the only row is its own
next; other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W

PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 741_103_597)
SPAN = 16           # characters of a sampled span
SAMPLE = 32         # smallest span hashes kept
GRID = [1, 2, 3, 4, 6, 8, 11]               # prefix lengths with a hash, then growing by sqrt(2)
while GRID[-1] < 1 << 40:
    GRID.append(GRID[-2] * 2)

BLOCKS = 1 << 18    # so many block openings (a few numbers each) are broadcast; more are joined
_P, _BITS = np.uint64(PRIME), np.uint64(31)


class _Tables:
    """base**i and base**-i modulo PRIME for both bases, grown on demand."""

    up = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    down = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    @classmethod
    def upto(cls, n: int):
        while len(cls.up[0]) < n:
            k = len(cls.up[0])
            for b, base in enumerate(BASES):
                cls.up[b] = np.concatenate([cls.up[b], cls.up[b] * np.uint64(pow(base, k, PRIME)) % _P])
                inverse = pow(pow(base, -1, PRIME), k, PRIME)
                cls.down[b] = np.concatenate([cls.down[b], cls.down[b] * np.uint64(inverse) % _P])
        return cls.up, cls.down


class PrefixHash:
    """Modular prefix arrays (two bases, 62 bits together) of code points.
    Texts laid end to end share one pair of arrays: a span's hash does not
    depend on where it stands."""

    def __init__(self, chars: np.ndarray | str):
        if isinstance(chars, str):
            chars = points(chars)
        chars = chars.astype(np.uint64) + np.uint64(1)
        self.n = len(chars)
        up, self.down = _Tables.upto(self.n + 1)
        self.sums = []
        for b in range(2):
            s = np.zeros(self.n + 1, np.uint64)
            term = chars * up[b][:self.n]                       # below 2**52
            np.cumsum((term & _P) + (term >> _BITS), out=s[1:])
            self.sums.append(s % _P)

    def _base(self, b, start, end):
        s = self.sums[b]
        return (s[end] + _P - s[start]) * self.down[b][start] % _P

    def span(self, start, end):
        """Hash of text[start:end]; arrays of positions give arrays."""
        return (self._base(0, start, end) << _BITS) | self._base(1, start, end)

    def windows(self, size: int) -> np.ndarray:
        """First-base hashes of all spans of ``size`` characters."""
        s, n = self.sums[0], self.n - size + 1
        return (s[size:] + _P - s[:n]) * self.down[0][:n] % _P

    def equal(self, start: int, other: "PrefixHash", at: int, size: int) -> bool:
        return bool(self.span(start, start + size) == other.span(at, at + size))

    def common(self, start: int, other: "PrefixHash", at: int) -> int:
        """Longest common extension of text[start:] and other[at:]."""
        lo, hi = 0, min(self.n - start, other.n - at)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(start, other, at, mid) else (lo, mid - 1)
        return lo

    def extensions(self, start: np.ndarray, other: "PrefixHash", at: np.ndarray, most: np.ndarray) -> np.ndarray:
        """``common`` for arrays of places, each up to ``most`` characters."""
        lo, hi = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = self.span(start, start + mid) == other.span(at, at + mid)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def sketches(chars: np.ndarray, offs: np.ndarray, ph: PrefixHash | None = None) -> list["Sketch"]:
    """Fingerprints of texts laid end to end (``ph``: their prefix arrays, where made)."""
    ph = ph or PrefixHash(chars)
    start, size = offs[:-1], np.diff(offs)
    full = W.mix(ph.span(start, offs[1:])).tolist()
    # hashes of prefixes
    lengths = np.array(GRID)
    many = np.searchsorted(lengths, size, side="right")
    own = np.repeat(start, many)
    edge = np.concatenate([[0], np.cumsum(many)])
    at = lengths[np.arange(edge[-1]) - np.repeat(edge[:-1], many)]
    prefixes = (W.mix(ph.span(own, own + at)) >> np.uint64(32)).tolist()
    # smallest span hashes: first those under a limit that leaves about 4 * SAMPLE, else all
    spans = np.maximum(size - SPAN + 1, np.minimum(size, 1))
    lows = [np.zeros(0, np.uint64)] * len(size)
    if ph.n >= SPAN:
        h = ph.windows(SPAN) * np.uint64(0x9E3779B97F4A7C15)           # high bits are mixed
        limit = np.minimum(4.0 * SAMPLE / np.maximum(spans, 1), 1.0) * 1.8e19
        bound = np.repeat(np.where(size >= SPAN, limit, 0).astype(np.uint64), size)[:len(h)]
        spot = np.flatnonzero(h < bound)
        doc = np.searchsorted(offs, spot, side="right") - 1
        ok = spot + SPAN <= offs[doc + 1]
        spot, doc = spot[ok], doc[ok]
        value = _low(ph, spot, spot + SPAN)
        cut = np.searchsorted(doc, np.arange(len(size) + 1))
        lows = [value[a:b] for a, b in zip(cut[:-1], cut[1:])]
    out = []
    for i in range(len(size)):
        low = np.unique(lows[i])
        if len(low) < SAMPLE and spans[i]:
            p = np.arange(start[i], start[i] + spans[i])
            low = np.unique(_low(ph, p, p + min(SPAN, int(size[i]))))
        out.append(Sketch(int(size[i]), full[i], prefixes[edge[i]:edge[i + 1]], low[:SAMPLE].tolist()))
    return out


def _low(ph: PrefixHash, start, end) -> np.ndarray:
    """40 bits by which spans are sampled, in the order of ``windows``' mixed
    first base, the second base behind it."""
    first = ph._base(0, start, end) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    return (first << np.uint64(16)) | (ph._base(1, start, end) >> np.uint64(15))


class Sketch:
    """What a fingerprint string holds."""

    def __init__(self, n: int, full: int, prefixes: list[int], low: list[int]):
        self.n, self.full, self.prefixes, self.low = n, full, prefixes, low

    def __str__(self) -> str:
        return (f"{self.n:x}.{self.full:016x}." + "".join(f"{p:08x}" for p in self.prefixes) + "."
                + "".join(f"{x:010x}" for x in self.low))

    @staticmethod
    def parse(text: str) -> "Sketch":
        n, full, prefixes, low = text.split(".")
        return Sketch(int(n, 16), int(full, 16), [int(prefixes[i:i + 8], 16) for i in range(0, len(prefixes), 8)],
                      [int(low[i:i + 10], 16) for i in range(0, len(low), 10)])


def likeness(a: Sketch, b: Sketch) -> float:
    if (a.n, a.full) == (b.n, b.full):
        return 1.0
    if not a.n or not b.n:
        return 0.0
    lo, hi = 0, min(len(a.prefixes), len(b.prefixes))
    while lo < hi:                       # equal prefixes come first: binary search for the last
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a.prefixes[mid - 1] == b.prefixes[mid - 1] else (lo, mid - 1)
    shared = GRID[lo - 1] / max(a.n, b.n) if lo else 0.0
    x, y = set(a.low), set(b.low)
    low = sorted(x | y)[:SAMPLE]
    return min(max(shared, sum(v in x and v in y for v in low) / max(1, len(low))), 1.0)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, common_edited long, common_next long")


def _scan(batches):
    """Rows of a block in order, closed by the first row of the next block."""
    held = None                          # the last row of the slice before: it waits for its next
    for part in W.slices(batches, "text", limit=1 << 18):
        if held is not None:
            part = pa.concat_batches([held, part])
        held = part.slice(part.num_rows - 1)
        n = part.num_rows - 1
        if not n:
            continue
        block = part.column("block").to_numpy()
        ready = np.flatnonzero((block[:-1] == block[1:]) & (part.column("tail").to_numpy()[:-1] == 0))
        data, at = W.column_bytes(part.column("text"))
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])       # characters before each byte
        offs = before[at]
        chars = points(data.tobytes().decode())
        ph = PrefixHash(chars)
        mine = sketches(chars, offs, ph)
        size = np.diff(offs)
        half = size[ready] // 2
        taken = np.minimum(half, size[ready + 1])
        pieces = []
        for i, h, t in zip(ready, half, taken):
            pieces += [chars[offs[i]:offs[i + 1] - h], chars[offs[i + 1]:offs[i + 1] + t]]
        if not len(ready):
            continue
        edited = np.concatenate(pieces)
        ends = np.concatenate([[0], np.cumsum(size[ready] - half + taken)])
        edited_ph = PrefixHash(edited)
        theirs = sketches(edited, ends, edited_ph)
        sha = [hashlib.sha256(edited[a:b].tobytes().decode("utf-32-le").encode()).hexdigest()
               for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(ready)), pa.array(size[ready], pa.int64()), pa.array(sha),
             pa.array([str(mine[i]) for i in ready]), pa.array([str(x) for x in theirs]),
             pa.array([likeness(mine[i], x) for i, x in zip(ready, theirs)], pa.float64()),
             pa.array([likeness(mine[i], mine[i + 1]) for i in ready], pa.float64()),
             pa.array(ph.extensions(offs[ready], edited_ph, ends[:-1], np.minimum(size[ready], np.diff(ends)))),
             pa.array(ph.extensions(offs[ready], ph, offs[ready + 1], np.minimum(size[ready], size[ready + 1])))],
            names=[f.split()[0] for f in _SCHEMA.split(", ")])


def fingerprints(docs: DataFrame, rows_per_block: int = 1024) -> DataFrame:
    """Fingerprint of every text and of its edit with the next text, in
    ascending doc_id order (after the last comes the first).

    The order is cut into blocks of neighbouring ids by at most 64 sampled
    quantiles and even steps between them; each block also gets the first row
    of the following one, so every row meets its next without a global sort.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"),
                       F.coalesce("text", F.lit("")).alias("text"))
    keys = rows.select("key")
    n = keys.count()
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_block))
    steps = min(64, blocks)
    low = sorted(set(keys.approxQuantile("key", [i / steps for i in range(steps + 1)], 0.002))) if n else [0.0]
    cuts = [int(x) for x in low]
    sub = max(1, -(-blocks // max(1, len(cuts) - 1)))
    bounds = F.array(*[F.lit(c) for c in cuts])
    # place of the key among the cuts, then even steps up to the following cut
    index = F.greatest(F.size(F.filter(bounds, lambda c: c <= F.col("key"))), F.lit(1))
    here = F.get(bounds, index - 1).cast("double")
    there = F.coalesce(F.get(bounds, index), F.get(bounds, index - 1) + 1).cast("double")
    step = F.floor((F.col("key") - here) / F.greatest(there - here, F.lit(1.0)) * sub)
    block = (index * sub + F.greatest(F.lit(0), F.least(F.lit(sub - 1), step))).cast("int")
    rows = rows.withColumn("block", block)
    # one row per block: its smallest key, and the block before it in the circle
    circle = Window.orderBy("block")
    opening = rows.groupBy("block").agg(F.min("key").alias("key")).select(
        "block", "key", F.coalesce(F.lag("block").over(circle), F.max("block").over(Window.partitionBy())).alias("previous"))
    sized = F.broadcast if blocks <= BLOCKS else (lambda df: df)      # a row of a few numbers per block
    tie = rows.join(sized(opening), ["block", "key"]).groupBy("block", "key", "previous").agg(
        F.min(F.xxhash64("text")).alias("first_hash"))       # equal ids: the one that comes first
    marked = rows.withColumn("hash", F.xxhash64("text")).join(
        sized(tie).select("block", "key", "previous", "first_hash"), ["block", "key"], "left")
    first = F.col("previous").isNotNull() & (F.col("hash") == F.col("first_hash"))
    spread = marked.select(
        "doc_id", "key", "hash", "text",
        F.explode(F.when(first, F.array(F.struct(F.col("block"), F.lit(0).alias("tail")),
                                        F.struct(F.col("previous").alias("block"), F.lit(1).alias("tail"))))
                  .otherwise(F.array(F.struct(F.col("block"), F.lit(0).alias("tail"))))).alias("at"))
    dealt = (spread.select("at.block", "at.tail", "key", "hash", "doc_id", "text")
             .repartition(blocks, "block").sortWithinPartitions("block", "tail", "key", "hash"))
    return dealt.select("block", "tail", "doc_id", "text").mapInArrow(_scan, _SCHEMA)
