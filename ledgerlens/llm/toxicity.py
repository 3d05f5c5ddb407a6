"""Toxicity by nearest labelled examples.

Texts are TF-IDF vectors over words that separate the labels; the examples
are held in an inverted index cut into blocks, with the largest weight of
each word in each block.  A text's exact ``NEIGHBOURS`` nearest examples by
cosine are found by opening blocks in order of their upper bound until no
closed block can hold a nearer one.  Similarity-weighted votes, calibrated on
the examples themselves (each without its own vote), give the score; the
evidence names the nearest examples.

Bounds: the vocabulary comes from at most ``SAMPLE`` labelled rows (those with
the smallest hashed ids, a fixed share of all; equal texts once), has at most ``TERMS`` words, and the index holds at
most ``EXAMPLES`` examples of each label.  Scoring covers whole texts of all rows.

Cases: null text counts as empty; texts with no vocabulary word get the share
of toxic ones among such examples; a document with several labels is toxic if
any says so; with no labels the score is 0; rows with a null doc_id are scored
but teach nothing; equal texts get equal scores; among equally near examples at the edge any may count, the
same ones each time; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .store import pin, sampled

SAMPLE = 20_000
TERMS = 2048
EXAMPLES = 2048
MIN_TEXTS = 3       # sample texts that hold a vocabulary word at least
MIN_G2 = 12.0       # its log-likelihood ratio against the labels at least
BLOCK = 64
NEIGHBOURS = 16
CUT = 0.3
_ROWS = 4096


def _words(data: np.ndarray, offs: np.ndarray):
    """Hash and text index of each lower-cased word of letters and digits."""
    start, end, first = W.find(data, offs, W.ALNUM)
    return W.hashes(W.LOWER[data], start, end), W.owner(first)


def _tally(batches):
    """Per word: sample texts that hold it, and how many of them are toxic."""
    seen = []
    for part in W.slices(batches, "text"):
        for at in range(0, part.num_rows, _ROWS):
            rows = part.slice(at, _ROWS)
            h, own = _words(*W.column_bytes(rows.column("text")))
            toxic = rows.column("toxic").to_numpy(zero_copy_only=False)
            key = np.unique(np.rec.fromarrays([h, own], names="h,d"))
            term, at_ = np.unique(key.h, return_inverse=True)
            seen.append((term, np.bincount(at_), np.bincount(at_, weights=toxic[key.d])))
    if not seen:
        return
    term, at_ = np.unique(np.concatenate([s[0] for s in seen]), return_inverse=True)
    n = np.bincount(at_, weights=np.concatenate([s[1] for s in seen]))
    t = np.bincount(at_, weights=np.concatenate([s[2] for s in seen]))
    for i in range(0, len(term), 1 << 17):
        j = slice(i, i + (1 << 17))
        yield pa.RecordBatch.from_arrays(
            [pa.array(term[j].view(np.int64)), pa.array(n[j].astype(np.int64)), pa.array(t[j].astype(np.int64))],
            names=["term", "n", "t"])


def vocabulary(sample: DataFrame, texts: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the words that separate the labels best, and their IDF."""
    n, t = F.col("n").cast("double"), F.col("t").cast("double")
    rest = F.lit(float(texts - toxic))

    def part(seen, of):
        return F.when(seen > 0, seen * F.log(seen * F.lit(float(texts)) / of)).otherwise(0.0)

    g2 = 2 * (part(t, n * float(toxic)) + part(n - t, n * rest)
              + part(F.lit(float(toxic)) - t, (F.lit(float(texts)) - n) * float(toxic))
              + part(rest - (n - t), (F.lit(float(texts)) - n) * rest))
    rows = (sample.mapInArrow(_tally, "term long, n long, t long").groupBy("term")
            .agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(F.col("n") >= MIN_TEXTS)
            .withColumn("g2", g2).where(F.col("g2") >= MIN_G2)
            .orderBy(F.desc("g2"), "term").limit(TERMS).collect())
    term = np.array([r.term for r in rows], dtype=np.int64).view(np.uint64)
    idf = np.log(texts / np.array([float(r.n) for r in rows]) + 1.0) if rows else np.zeros(0)
    order = np.argsort(term)
    return term[order], idf[order]


def vectors(data: np.ndarray, offs: np.ndarray, term: np.ndarray, idf: np.ndarray):
    """Unit TF-IDF vectors of the texts: (first entry of each text, words, weights)."""
    n = len(offs) - 1
    h, own = _words(data, offs)
    if len(term) == 0 or len(h) == 0:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(term, h), len(term) - 1)
    hit = term[at] == h
    key, tf = np.unique(own[hit] * len(term) + at[hit], return_counts=True)
    doc, col = key // len(term), key % len(term)
    w = (1 + np.log(tf)) * idf[col]
    norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=n))
    return np.searchsorted(doc, np.arange(n + 1)), col, w / norm[doc]


class BlockMaxIndex:
    """Inverted index of unit vectors in blocks of ``BLOCK`` examples: per word
    and block the largest weight, and the postings as one row of ``BLOCK``
    weights, which a reader opens block by block."""

    def __init__(self, first, col, weight, label, ids, n_terms):
        n = len(label)
        # examples that share their heaviest word stand together, so block maxima are tight
        heavy = np.array([col[a + np.argmax(weight[a:b])] if b > a else -1
                          for a, b in zip(first[:-1], first[1:])], dtype=np.int64)
        order = np.lexsort((ids, heavy, label))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.label, self.ids = label[order].astype(float), ids[order]
        own = place[np.repeat(np.arange(n), np.diff(first))]
        blocks = max(1, -(-n // BLOCK))
        key, self.row = np.unique(col * blocks + own // BLOCK, return_inverse=True)
        self.key, self.blocks, self.n_terms = key, blocks, n_terms
        self.slot, self.weight = own % BLOCK, weight
        self._open()

    def _open(self):
        self.postings = np.zeros((len(self.key) + 1, BLOCK))         # the last row: no posting
        self.postings[self.row, self.slot] = self.weight
        self.at = np.full((self.n_terms, self.blocks), len(self.key))
        self.at.ravel()[self.key] = np.arange(len(self.key))
        self.top = self.postings.max(axis=1)[self.at]                # largest weight by word and block

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("postings", "at", "top")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._open()

    def nearest(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1):
        """Exact nearest examples: (places, cosines), the nearest first."""
        bound = weights @ self.top[terms]
        order = np.argsort(-bound, kind="stable")
        best, score = np.zeros(0, np.int64), np.zeros(0)
        lists = self.at[terms]
        for done in range(0, len(order), 16):
            limit = bound[order[done]]
            if limit <= 1e-12 or len(best) == NEIGHBOURS and limit <= score[-1]:
                break
            group = order[done:done + 16]
            got = np.tensordot(weights, self.postings[lists[:, group]], 1).ravel()
            keep = np.flatnonzero(got >= (score[-1] if len(best) == NEIGHBOURS else 1e-12))
            place = (group[:, None] * BLOCK + np.arange(BLOCK)).ravel()[keep]
            best, score = np.concatenate([best, place]), np.concatenate([score, got[keep]])
            if skip >= 0:
                best, score = best[best != skip], score[best != skip]
            top = np.lexsort((best, -score))[:NEIGHBOURS]
            best, score = best[top], score[top]
        return best, score

    def vote(self, terms, weights, skip=-1):
        place, cosine = self.nearest(terms, weights, skip)
        return (float(self.label[place] @ cosine / cosine.sum()) if len(place) else np.nan), place, cosine


def _platt(v: np.ndarray, y: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Slope and offset of the logistic curve from votes to labels; ``share``
    weighs each example by the sample rows it stands for."""
    x = np.column_stack([v, np.ones(len(v))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        w += np.linalg.solve(curve, x.T @ (share * (y - p)) - 0.1 * w)
    return w


class Model:
    def __init__(self, term, idf, index, curve, empty):
        self.term, self.idf, self.index, self.curve, self.empty = term, idf, index, curve, empty

    def score(self, data, offs):
        first, col, weight = vectors(data, offs, self.term, self.idf)
        out = np.full(len(offs) - 1, self.empty)
        evidence = [""] * len(out)
        for i in np.flatnonzero(np.diff(first)):
            a, b = first[i], first[i + 1]
            v, place, cosine = self.index.vote(col[a:b], weight[a:b])
            if len(place):
                out[i] = 1 / (1 + np.exp(-np.clip(self.curve[0] * v + self.curve[1], -30, 30)))
                evidence[i] = " ".join(f"{self.index.ids[p]}:{c:.3f}" for p, c in zip(place[:3], cosine[:3]))
        return out, evidence


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """``labels``: doc_id and toxic of the rows that may teach."""
    known = sampled(pin(labels.where("toxic is not null and doc_id is not null").groupBy("doc_id")
                        .agg(F.max("toxic").cast("double").alias("toxic"))), "doc_id", SAMPLE)   # two numbers a row
    # one row of each text: copies of a labelled text would make all its words telling
    sample = pin(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
                 .join(F.broadcast(known), "doc_id").groupBy(F.xxhash64("text").alias("copy"))
                 .agg(F.min_by("text", "doc_id").alias("text"), F.max("toxic").alias("toxic"),
                      F.min("doc_id").alias("doc_id")).select("doc_id", "text", "toxic"))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    if n == 0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), None, (0.0, 0.0), 0.0)
    term, idf = vocabulary(sample.select("text", "toxic"), int(n), int(toxic))

    def sparse(batches):
        for part in W.slices(batches, "text"):
            first, col, weight = vectors(*W.column_bytes(part.column("text")), term, idf)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("toxic"),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(col, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(weight, pa.float64()))],
                names=["doc_id", "toxic", "col", "weight"])

    seen = pin(sample.select("doc_id", "toxic", "text")
               .mapInArrow(sparse, "doc_id long, toxic double, col array<int>, weight array<double>"))
    bare = seen.where(F.size("col") == 0).agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0.0))).first()
    empty = float((bare[1] + 0.5 * toxic / n) / (bare[0] + 0.5))
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.hash("col")]
    rows = [r for side in (1.0, 0.0) for r in
            seen.where((F.size("col") > 0) & (F.col("toxic") == side)).orderBy(*order).limit(EXAMPLES).collect()]
    if not rows:
        return Model(term, idf, None, (0.0, 0.0), empty)
    first = np.concatenate([[0], np.cumsum([len(r.col) for r in rows])])
    col = np.concatenate([np.array(r.col, dtype=np.int64) for r in rows])
    weight = np.concatenate([np.array(r.weight) for r in rows])
    label = np.array([r.toxic for r in rows])
    ids = np.array([r.doc_id for r in rows], dtype=np.int64)
    index = BlockMaxIndex(first, col, weight, label, ids, len(term))
    # calibration: each example judged by the others
    place_of = {int(d): i for i, d in enumerate(index.ids)}
    votes = np.array([index.vote(col[a:b], weight[a:b], place_of[int(d)])[0]
                      for a, b, d in zip(first[:-1], first[1:], ids)])
    ok = ~np.isnan(votes)
    size = {r.toxic: r["count"] for r in seen.where(F.size("col") > 0).groupBy("toxic").count().collect()}
    share = np.array([size[t] / (label == t).sum() for t in label])
    curve = _platt(votes[ok], label[ok], share[ok] / share.mean()) if ok.any() else np.zeros(2)
    return Model(term, idf, index, curve, empty)


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """score, predicted and evidence beside the columns ``keep``; with
    ``text`` among them, whole rows for a filter."""
    schema = docs.select(*keep).schema

    def run(batches):
        for part in W.slices(batches, "text"):
            for at in range(0, part.num_rows, _ROWS):
                rows = part.slice(at, _ROWS)
                data, offs = W.column_bytes(rows.column("text"))
                if model.index is None:
                    s, why = np.full(rows.num_rows, model.empty), [""] * rows.num_rows
                else:
                    s, why = model.score(data, offs)
                s = np.clip(s, 0, 1)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(k) for k in keep), pa.array(s), pa.array((s >= CUT).astype(np.int32)),
                     pa.array(why, pa.string())], names=[*keep, "score", "predicted", "evidence"])

    out = T.StructType([*schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
                        T.StructField("evidence", T.StringType())])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, out)


def score(docs: DataFrame, labels: DataFrame, held) -> DataFrame:
    """Learn from labelled rows outside ``held`` (a column over doc_id); score all."""
    model = learn(docs, labels.where(~held))
    return predict(docs.withColumn("held_out", held), model, "doc_id", "held_out")
