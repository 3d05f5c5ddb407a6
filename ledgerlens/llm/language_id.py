"""Language ID by multilingual mixture inference.

Each language is a distribution over hashed byte trigrams, counted over every
training document.  A document's trigrams are taken as drawn from a mixture
of languages: expectation-maximisation estimates the proportions, once for
each nested set of its most likely languages, and the set with the best
penalised likelihood gives the answer.

Cases: a null or letterless text is ``und`` with score 0; null languages teach
nothing; with no training language every text is ``und``; a null doc_id is
never held out and teaches like any other row; repeated rows each get their
row; other columns are ignored.  The model holds ``languages x BUCKETS``
numbers, whatever the size of the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

BUCKETS = 8192      # hashed trigrams
MAX_SET = 3         # languages in one document's set at most
ROUNDS = 8          # expectation-maximisation rounds per set
PENALTY = 3.0       # times log(n) / 2 per extra language; trigrams overlap threefold
SMOOTH = 0.5
_ROWS = 256         # texts worked on at once


def _trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text index of each trigram of lower-cased bytes."""
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = W.LOWER[data].astype(np.uint32)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)
    length = np.diff(offs)
    own = np.repeat(np.arange(len(length)), length)[:-2]
    inside = own == np.repeat(np.arange(len(length)), length)[2:]
    return bucket[inside], own[inside]


def _count(batches):
    """Trigram counts per language of one task's documents."""
    totals: dict[str, np.ndarray] = {}
    for part in W.slices(batches, "text"):
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        data, offs = W.column_bytes(part.column("text"))
        bucket, own = _trigrams(data, offs)
        for lang in set(langs):
            here = (langs == lang)[own]
            got = np.bincount(bucket[here], minlength=BUCKETS)
            totals[lang] = totals[lang] + got if lang in totals else got
    for lang, counts in totals.items():
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
             pa.array(counts[at], pa.int64())], names=["lang", "bucket", "n"])


def learn(docs: DataFrame, where) -> tuple[list[str], np.ndarray]:
    """Languages in order, and their trigram probabilities (languages x BUCKETS)."""
    rows = (docs.where(where & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("lang", "text")
            .mapInArrow(_count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    langs = sorted({r.lang for r in rows})
    counts = np.full((len(langs), BUCKETS), SMOOTH)
    for r in rows:
        counts[langs.index(r.lang), r.bucket] += r.n
    return langs, counts / counts.sum(axis=1, keepdims=True)


def _mixture(p, c, doc, starts, total, pi):
    """Proportions after ROUNDS of expectation-maximisation, and log-likelihood.
    p: probability of each (document, trigram) under each language."""
    for _ in range(ROUNDS):
        r = p * pi[doc]
        s = r.sum(axis=1)
        r *= (c / s)[:, None]
        pi = np.add.reduceat(r, starts, axis=0) / total[:, None]
    return pi, np.add.reduceat(c * np.log((p * pi[doc]).sum(axis=1)), starts)


def infer(data: np.ndarray, offs: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages) of the chosen set; zero rows where a
    text has no trigram."""
    n, k = len(offs) - 1, len(model)
    out = np.zeros((n, k))
    bucket, own = _trigrams(data, offs)
    table = np.bincount(own * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    doc, col = np.nonzero(table)
    if len(doc) == 0:
        return out
    c = table[doc, col].astype(float)
    have, starts, doc = np.unique(doc, return_index=True, return_inverse=True)
    total = np.add.reduceat(c, starts)
    p = model[:, col].T.copy()
    p /= p.max(axis=1, keepdims=True)
    full, _ = _mixture(p, c, doc, starts, total, np.full((len(have), k), 1.0 / k))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1)
    best = np.full(len(have), -np.inf)
    for size in range(1, min(MAX_SET, k) + 1):
        pi = np.where(rank < size, np.maximum(full, 1e-6), 0.0)
        pi /= pi.sum(axis=1, keepdims=True)
        if size == 1:
            like = np.add.reduceat(c * np.log((p * pi[doc]).sum(axis=1)), starts)
        else:
            pi, like = _mixture(p, c, doc, starts, total, pi)
        like -= PENALTY * (size - 1) * np.log(total) / 2
        better = like > best
        best = np.where(better, like, best)
        out[have[better]] = pi[better]
    return out


def predict(docs: DataFrame, langs: list[str], model: np.ndarray) -> DataFrame:
    """lang_pred, score (its share) and the chosen set of languages per row."""
    names = np.array(langs + ["und"], dtype=object)

    def run(batches):
        for part in W.slices(batches, "text"):
            for at in range(0, part.num_rows, _ROWS):
                rows = part.slice(at, _ROWS)
                data, offs = W.column_bytes(rows.column("text"))
                share = infer(data, offs, model) if langs else np.zeros((rows.num_rows, 1))
                known = rows.column("letters").to_numpy(zero_copy_only=False) & bool(langs)
                # a letter but no trigram (one or two bytes): no evidence, so the first language
                top = np.where(known, share.argmax(axis=1), len(langs))
                score = np.where(known, share.max(axis=1), 0.0)
                sets = ["" if not k else "+".join(names[j] for j in np.argsort(-s, kind="stable") if s[j] > 0)
                        for s, k in zip(share, known)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), rows.column("held_out"),
                     pa.array(names[top], pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()),
                     pa.array(sets, pa.string())],
                    names=["doc_id", "held_out", "lang_pred", "score", "languages"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return (docs.select("doc_id", "held_out", letters, "text")
            .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, languages string"))


def identify(docs: DataFrame, held) -> DataFrame:
    """Learn from the rows outside ``held`` (a boolean column), predict all."""
    langs, model = learn(docs, ~held)
    return predict(docs.select("doc_id", "text", held.alias("held_out")), langs, model)
