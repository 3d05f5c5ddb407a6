"""Quality scores by Bradley-Terry pairwise ranking.

Every text gets a few dozen shape features in one vectorised pass.  Labelled
texts give preference pairs (a good one over a poor one); the weights minimise
the logistic loss on feature differences, so a score difference is the
log-odds of being preferred.  The cut is a quantile of the scores of all
labelled texts: the share of poor ones among them.

Bounds: only the weights are fitted on a sample, of at most ``SAMPLE`` labelled
rows (those with the smallest hashed ids, a fixed share of all) and ``PAIRS``
drawn pairs.  Mean and spread of the features are those of all rows, share and
quantile those of all labelled rows (by Spark; the quantile to one part in
``_EXACT`` of the ranks).

Cases: null text counts as empty and is scored like any other; a document
with several labels has the highest; without both labels every score is the
share of good ones (0.5 without labels); rows with a null doc_id are scored
but teach nothing; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import pin, sampled

SAMPLE = 20_000
PAIRS = 200_000
CUT = 0.3           # the score at which the quantile lies
_EXACT = 100_000
_RIDGE = 1.0
_ROWS = 4096        # texts worked on at once (12 bits of the distinct-word key)

_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_PLAIN = W.ALNUM | ~W.SPACE
_PLAIN[[ord(c) for c in ".,'-"]] = True
FEATURES = ("log_words", "word_len", "long_words", "short_words", "upper", "digits", "symbols", "marks",
            "dots", "commas", "lines", "line_words", "distinct", "repeats", "repeats2", "odd_words", "wide")


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """texts x FEATURES."""
    n = len(offs) - 1
    start, end, first = W.find(data, offs)
    h = W.hashes(W.LOWER[data], start, end)
    own = W.owner(first)
    n_words = np.diff(first)
    words, size = np.maximum(n_words, 1), np.maximum(np.diff(offs), 1)

    def per_byte(mask):
        total = np.concatenate([[0], np.cumsum(mask)])
        return (total[offs[1:]] - total[offs[:-1]]).astype(float)

    def per_word(mask):
        return np.bincount(own[mask], minlength=n).astype(float)

    length = end - start
    key = (own.astype(np.uint64) << np.uint64(52)) | (h >> np.uint64(12))
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(52)).astype(np.int64), minlength=n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (own[1:] == own[:-1])
    again2 = np.zeros(len(h), bool)
    again2[2:] = (h[2:] == h[:-2]) & (own[2:] == own[:-2])
    symbol = ~_PLAIN[data]
    sym = np.concatenate([[0], np.cumsum(symbol)])
    odd = sym[end] - sym[start] > 0
    lines = per_byte(data == 10) + 1
    return np.column_stack([
        np.log1p(n_words), per_byte(W.SPACE[data]) / words, per_word(length > 12) / words,
        per_word(length <= 2) / words, per_byte(_UPPER[data]) / size, per_byte(_DIGIT[data]) / size,
        per_byte(symbol) / size, per_byte((data == 33) | (data == 63)) / words, per_byte(data == 46) / words,
        per_byte(data == 44) / words, np.log(lines), np.log(words / lines), distinct / words,
        per_word(again) / words, per_word(again2) / words, per_word(odd) / words,
        per_byte(data >= 128) / size]) if n else np.zeros((0, len(FEATURES)))


def _measure(batches):
    for part in W.slices(batches, "text"):
        for at in range(0, part.num_rows, _ROWS):
            rows = part.slice(at, _ROWS)
            f = features(*W.column_bytes(rows.column("text")))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id").cast(pa.int64()), rows.column("held_out"),
                 pa.FixedSizeListArray.from_arrays(pa.array(f.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))],
                names=["doc_id", "held_out", "f"])


def _expand(f: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and their squares."""
    z = np.clip((f - mean) / scale, -6, 6)
    return np.column_stack([z, z * z])


def fit_pairs(good: np.ndarray, poor: np.ndarray, seed: int = 7) -> np.ndarray:
    """Bradley-Terry weights by Newton steps on drawn (good, poor) pairs."""
    rng = np.random.default_rng(seed)
    n = min(PAIRS, 20 * (len(good) + len(poor)))
    d = good[rng.integers(len(good), size=n)] - poor[rng.integers(len(poor), size=n)]
    w = np.zeros(d.shape[1])
    for _ in range(15):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) - _RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d + _RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def rate(f: np.ndarray, model) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(f), model)
    mean, scale, w, cut, spread = model
    z = (_expand(f, mean, scale) @ w - cut) / spread + np.log(CUT / (1 - CUT))
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(column) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), len(FEATURES))


def _moments(batches):
    """Per task and feature: rows, sum, sum of squares."""
    n, total, square = 0, np.zeros(len(FEATURES)), np.zeros(len(FEATURES))
    for b in batches:
        f = _features(b.column("f"))
        n, total, square = n + len(f), total + f.sum(axis=0), square + (f * f).sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(range(len(FEATURES)), pa.int32()), pa.array([n] * len(FEATURES), pa.int64()),
                                      pa.array(total), pa.array(square)], names=["i", "n", "total", "square"])


def _fitted(measured: DataFrame, known: DataFrame, sample, share: float):
    """(mean, scale, weights, cut, spread)."""
    sums = (measured.select("f").mapInArrow(_moments, "i int, n long, total double, square double").groupBy("i")
            .agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("square").alias("square")).orderBy("i").collect())
    mean = np.array([r.total / r.n for r in sums])
    scale = np.sqrt(np.maximum([r.square / r.n for r in sums] - mean ** 2, 1e-12))
    y = np.array([r.quality for r in sample])
    x = _expand(np.array([r.f for r in sample]), mean, scale)
    w = fit_pairs(x[y == 1], x[y == 0])

    def raw(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_expand(_features(b.column("f")), mean, scale) @ w)], names=["s"])

    judged = measured.join(known.select(F.col("doc_id").alias("id")), F.col("doc_id") == F.col("id"), "left_semi").select("f")
    scores = judged.mapInArrow(raw, "s double")
    low, spread = scores.agg(F.percentile_approx("s", 1 - share, _EXACT), F.stddev_pop("s")).first()
    high = scores.where(F.col("s") > low).agg(F.min("s")).first()[0]
    cut = low if high is None else (low + high) / 2          # between two scores, so that ties fall on one side
    return mean, scale, w, cut, max(spread / 4, 1e-6)


def score(docs: DataFrame, labels: DataFrame, held) -> DataFrame:
    """Learn from labelled rows outside ``held``; score and judge all rows."""
    measured = pin(docs.select("doc_id", held.alias("held_out"), "text")
                   .mapInArrow(_measure, "doc_id long, held_out boolean, f array<double>"))
    teach = measured.where("not held_out").select(F.col("doc_id").alias("id"))
    known = pin(labels.where("quality is not null and doc_id is not null").groupBy("doc_id")
                .agg(F.max("quality").alias("quality")).join(teach, F.col("doc_id") == F.col("id"), "left_semi"))
    rows = (measured.join(sampled(known, "doc_id", SAMPLE), "doc_id").groupBy("doc_id", "quality")
            .agg(F.min_by("f", F.xxhash64("f")).alias("f")).collect())       # one row of a repeated id
    rows.sort()
    share = known.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    model = 0.5 if share is None else float(share)
    if 0 < model < 1 and len({r.quality for r in rows}) == 2:
        model = _fitted(measured, known, rows, model)

    def run(batches):
        for b in batches:
            s = rate(_features(b.column("f")), model)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s),
                 pa.array((s >= CUT).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return measured.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
