"""Centroid clustering over a vector-approximation file.

Vectors are integers here: floor(64 * x) of each component.  Beside each full
vector stands its approximation, a cell number of ``BITS`` bits per dimension.
For given centroids two lookup tables per dimension hold the least and the
greatest squared difference between a cell and a centroid; summed over the
dimensions they bound the distance to each centroid.  A centroid whose lower
bound exceeds another one's upper bound is out; the full vector is fetched
(decoded from its column) only where two or more intervals still overlap, or
where the vector changed its cluster and so moves a sum.

1. one scan gives the cells' borders (count, mean, spread, range of each
   dimension; where the range has no more integers than there are cells, every
   integer is a cell of its own);
2. one scan writes the approximation file;
3. each round is one scan: assignment under the centroids before and now, sums
   and counts of the vectors that moved, folded per task, then by Spark.  All
   arithmetic is in 64-bit integers, so sums are exact whatever the partitions.

No vector is shuffled; the driver gets ``k`` centroids and their sums.

Cases: vectors that are null, of another length, or hold a null or non-finite
component are left out; a null vec_id is assigned but is never a start; equal
ids are vectors of their own, ties of the start order fall to the smaller
vector; with fewer vectors than ``k`` there are as many centroids as vectors;
an empty table gives no rows; other columns are ignored.  Components beyond
+-2**27 are held there: a squared distance beyond them would not fit a long.
A sum of distances that does not fit a long is null.
"""

from __future__ import annotations

import hashlib
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import pin, unpin

DIM = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
BITS = 6
LIMIT = 1 << 27         # largest component
_ROWS = 2048            # vectors worked on at once


def integers(vectors: DataFrame, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (array<int>) of the rows with ``dim`` finite components."""
    x = F.col("embedding").cast("array<double>")
    whole = (F.size(x) == dim) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    held = F.transform(x, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))).cast("int"))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
            .where(F.coalesce(whole, F.lit(False))).select("vec_id", held.alias("vector")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _range(dim: int):
    def run(batches):
        n, total, square = 0, np.zeros(dim), np.zeros(dim)
        low, high = np.full(dim, LIMIT), np.full(dim, -LIMIT)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vector"), dim)
            n += len(x)
            total += x.sum(0)
            square += (x.astype(float) ** 2).sum(0)
            low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(np.full(dim, n)), pa.array(total), pa.array(square),
                                              pa.array(low), pa.array(high)], names=["d", "n", "total", "square", "low", "high"])
    return run


class Cells:
    """Cell borders of every dimension, and the bounds they give."""

    def __init__(self, stats, bits: int):
        self.low, self.high = [], []              # least and greatest value of each cell, per dimension
        quantiles = [NormalDist().inv_cdf(k / (1 << bits)) for k in range(1, 1 << bits)]
        for s in stats:
            if s.high - s.low < 1 << bits:
                inner = np.arange(s.low + 1, s.high + 1)
            else:
                mean = s.total / s.n
                spread = max(s.square / s.n - mean * mean, 0.0) ** 0.5
                inner = np.unique(np.rint(mean + spread * np.array(quantiles)).astype(np.int64))
                inner = inner[(inner > s.low) & (inner <= s.high)]
            self.low.append(np.concatenate([[s.low], inner]).astype(np.int64))
            self.high.append(np.concatenate([inner - 1, [s.high]]).astype(np.int64))

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(low, x[:, d], side="right") - 1 for d, low in enumerate(self.low)], 1).astype(np.uint8)

    def tables(self, centroids: np.ndarray):
        """Per dimension, (cells, centroids): least and greatest squared difference."""
        out = []
        for d, (low, high) in enumerate(zip(self.low, self.high)):
            c = centroids[:, d][None, :]
            below, above = c - low[:, None], c - high[:, None]
            least = np.where((below >= 0) & (above <= 0), 0, np.minimum(below * below, above * above))
            out.append((least, np.maximum(below * below, above * above)))
        return out


def nearest(cells: np.ndarray, tables, fetch, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """Nearest centroid of each vector by its cells; ``fetch(rows)`` gives the
    full vectors of those whose intervals overlap.  Also how many those were."""
    lower = np.zeros((len(cells), len(centroids)), np.int64)
    upper = np.zeros_like(lower)
    for d, (least, most) in enumerate(tables):
        lower += least[cells[:, d]]
        upper += most[cells[:, d]]
    may = lower <= upper.min(1)[:, None]
    best = may.argmax(1)
    open_ = np.flatnonzero(may.sum(1) > 1)
    if len(open_):
        row, k = np.nonzero(may[open_])
        gap = fetch(open_)[row] - centroids[k]
        exact = np.full((len(open_), len(centroids)), np.iinfo(np.int64).max)
        exact[row, k] = (gap * gap).sum(1)
        best[open_] = exact.argmin(1)                     # the smaller number among equals
    return best, len(open_)


def _chunks(batches, dim: int):
    """(rows, cells, fetch) of at most ``_ROWS`` vectors."""
    for b in batches:
        for at in range(0, b.num_rows, _ROWS):
            rows = b.slice(at, _ROWS)
            cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), np.uint8).reshape(-1, dim)
            column = rows.column("vector")

            def fetch(pick, column=column):
                return np.frombuffer(b"".join(column.take(pa.array(pick)).to_pylist()), "<i4").reshape(-1, dim).astype(np.int64)

            yield rows, cells, fetch


def _encode(cells: Cells, dim: int):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("vector"), dim)
                yield pa.RecordBatch.from_arrays(
                    [b.column("vec_id"), pa.array([r.tobytes() for r in cells.encode(x)], pa.binary()),
                     pa.array([r.tobytes() for r in x.astype("<i4")], pa.binary())], names=["vec_id", "cells", "vector"])
    return run


def _moves(cells: Cells, before, now: np.ndarray, dim: int):
    """Per task and centroid: count and sums that the step from ``before`` (None:
    nothing assigned yet) to ``now`` brings; the last row counts fetched vectors."""
    def run(batches):
        old_tables = None if before is None else cells.tables(before)
        tables, k = cells.tables(now), len(now)
        count, sums, fetched = np.zeros(k, np.int64), np.zeros((k, dim), np.int64), 0
        for _, approx, fetch in _chunks(batches, dim):
            new, opened = nearest(approx, tables, fetch, now)
            old = np.full(len(new), -1) if before is None else nearest(approx, old_tables, fetch, before)[0]
            moved = np.flatnonzero(new != old)
            if len(moved):
                x = fetch(moved)
                np.add.at(sums, new[moved], x)
                count += np.bincount(new[moved], minlength=k)
                if before is not None:
                    np.subtract.at(sums, old[moved], x)
                    count -= np.bincount(old[moved], minlength=k)
            fetched += opened
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k + 1)), pa.array(np.append(count, fetched)),
             pa.array([*sums.tolist(), [0] * dim], pa.list_(pa.int64()))], names=["k", "n", "sums"])
    return run


def _final(cells: Cells, centroids: np.ndarray, dim: int):
    def run(batches):
        tables = cells.tables(centroids)
        for rows, approx, fetch in _chunks(batches, dim):
            best, _ = nearest(approx, tables, fetch, centroids)
            gap = fetch(np.arange(len(best))) - centroids[best]
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), pa.array(best.astype(np.int32)), pa.array((gap * gap).sum(1))],
                names=["vec_id", "cluster", "distance"])
    return run


class Clustering:
    """``cluster``'s work, step by step: ``centroids``, ``assigned`` (vec_id,
    cluster, distance) and ``fetched`` (vectors opened for overlap, per round)."""

    def __init__(self, vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, bits: int = BITS,
                 dim: int = DIM, scale: int = SCALE):
        kept = integers(vectors, dim, scale)
        start = (kept.where("vec_id is not null")
                 .orderBy(F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256), "vector").limit(k).collect())
        self.centroids = np.array([r.vector for r in start], np.int64).reshape(-1, dim)
        self.fetched: list[int] = []
        self.assigned = None
        if not start:
            return
        stats = (kept.select("vector").mapInArrow(_range(dim), "d long, n long, total double, square double, low long, high long")
                 .groupBy("d").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square"),
                                   F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect())
        cells = Cells(stats, bits)
        file = pin(kept.mapInArrow(_encode(cells, dim), "vec_id long, cells binary, vector binary"))
        before, count, sums = None, [0] * len(start), [[0] * dim for _ in start]
        for _ in range(rounds):
            moves = file.select("cells", "vector").mapInArrow(_moves(cells, before, self.centroids, dim), "k long, n long, sums array<long>")
            folded = (moves.select("k", "n", F.posexplode("sums").alias("d", "s")).groupBy("k", "d")
                      .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())      # centroids x dimensions
            for r in folded:
                if r.k == len(start):
                    if r.d == 0:
                        self.fetched.append(r.n)
                    continue
                sums[r.k][r.d] += r.s
                if r.d == 0:
                    count[r.k] += r.n
            before = self.centroids
            self.centroids = np.array([[s // n for s in row] if n else list(old)
                                       for row, n, old in zip(sums, count, before.tolist())], np.int64)
        self.assigned = pin(file.mapInArrow(_final(cells, self.centroids, dim), "vec_id long, cluster int, distance long"))
        unpin(file)


def cluster(vectors: DataFrame, **settings) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256 of every kept vector."""
    spark = vectors.sparkSession
    done = Clustering(vectors, **settings)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if done.assigned is None:
        return spark.createDataFrame([], schema)
    per = {r.cluster: int(r.s) for r in done.assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}

    def long(x: int):
        return x if x < 1 << 63 else None

    facts = spark.createDataFrame(
        [(k, long(s), long(sum(per.values())), hashlib.sha256(",".join(map(str, done.centroids[k].tolist())).encode()).hexdigest())
         for k, s in per.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (done.assigned.join(F.broadcast(facts), "cluster")           # a row per centroid
            .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))


def _sql() -> str:
    """The definition itself: plain distances, ``ROUNDS`` times."""
    near = """
a{i} AS (SELECT r, k, d FROM (
  SELECT r, k, d, row_number() OVER (PARTITION BY r ORDER BY d, k) AS o FROM (
    SELECT r, k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM v CROSS JOIN c{i} c)) WHERE o = 1)"""
    move = """
s{i} AS (SELECT k, j, sum(x[j])::BIGINT AS s, count(*) AS n
  FROM (SELECT k, x, unnest(range(1, 65)) AS j FROM a{i} JOIN v USING (r)) GROUP BY k, j),
m{i} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS x FROM s{i} GROUP BY k),
c{o} AS (SELECT c{i}.k, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (k))"""
    steps = ",".join((near + "," + move).format(i=i, o=i + 1) for i in range(ROUNDS)) + "," + near.format(i=ROUNDS)
    return f"""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
c0 AS (SELECT k, x FROM (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), x) - 1 AS k, x FROM v WHERE vec_id IS NOT NULL)
  WHERE k < {CLUSTERS}),{steps}
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{ROUNDS}.x, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN v USING (r) JOIN c{ROUNDS} USING (k)
"""


SQL = _sql()
