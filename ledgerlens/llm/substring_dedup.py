"""Substring deduplication by level-wise doubling.

A word is removed when a window of ``WINDOW`` words over it also starts
earlier: in a document with a smaller id, or earlier in the same one.  Hashes
of short windows are compared first, and only windows repeated at one length
are extended to twice that length, until the full length is reached:

1. FIRST words.  Each full window is represented by its smallest short window
   (equal full windows have the same one at the same place), so about one
   position in eight is compared.
2. 2 * FIRST words, around the positions that survived.
3. WINDOW words.  Runs of full windows that stand whole in an earlier document
   are settled as runs; the others are compared window by window.

Windows are compared by 64-bit hashes.  Counts and smallest ids are
aggregated before they are joined back, so a passage that a third of all
documents share is one row per task; each level is written to the checkpoint
folder.

Cases: null text has no words; a null doc_id comes before all others; rows
with one doc_id are one place in the order (they do not remove each other's
words, each row is judged by itself); repeated rows each get their row; empty
tables give none; other columns are ignored (``cleaned`` returns them).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import pin, unpin

WINDOW = 20
FIRST = 5
_SPREAD = WINDOW - FIRST + 1        # short windows in a full one: a power of two
_LEFT = np.uint64(0x5851F42D4C957F2D)


def _runs(h: np.ndarray, first: np.ndarray):
    """Full windows by the short window that represents them.

    Returns the short windows' hashes, and per run of consecutive full windows
    with the same representative: its place, the first start, the number."""
    n = len(h)
    none = np.zeros(0, np.int64)
    short = np.full(n, W.MAX_U64)
    starts = np.flatnonzero(W.whole(first, n, WINDOW))
    if not len(starts):
        return short, none, none, none
    inside = W.whole(first, n, FIRST)
    short[:len(inside)] = np.where(inside, W.windows(h, FIRST), W.MAX_U64)
    low, at = short, np.arange(n)
    step = 1
    while step < _SPREAD:                     # leftmost smallest of 2, 4, 8, 16 neighbours
        right = low[step:] < low[:-step]
        low, at = np.where(right, low[step:], low[:-step]), np.where(right, at[step:], at[:-step])
        step *= 2
    place = at[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    lead = np.flatnonzero(new)
    return short, place[lead], starts[lead], np.diff(np.append(lead, len(starts)))


def _words(part: pa.RecordBatch):
    data, offs = W.column_bytes(part.column("text"))
    start, end, first = W.find(data, offs)
    return data, start, end, first, W.hashes(data, start, end)


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def _level_first(batches):
    for part in W.slices(batches, "text"):
        _, _, _, first, h = _words(part)
        short, place, _, _ = _runs(h, first)
        doc = pa.array(np.searchsorted(first, place, side="right") - 1)
        yield pa.RecordBatch.from_arrays(
            [_signed(short[place]), part.column("row").take(doc),
             pa.array((place - first[doc.to_numpy()]).astype(np.int32))], names=["h", "row", "place"])


def _level_second(batches):
    """Runs of full windows around surviving places, by the hash of 2 * FIRST
    words: those from the representative on where the window reaches so far,
    else those that end with it."""
    for part in W.slices(batches, "text"):
        _, _, _, first, h = _words(part)
        n = len(h)
        alive = np.zeros(n, bool)
        spots = part.column("places")
        own = np.repeat(first[:-1], np.diff(spots.offsets.to_numpy()))
        alive[own + spots.flatten().to_numpy()] = True
        _, place, begin, many = _runs(h, first)
        live = alive[place]
        place, begin, many = place[live], begin[live], many[live]
        if not len(place):
            continue
        sums = W.word_sums(h)
        double, full = W.windows(h, 2 * FIRST, sums), W.windows(h, WINDOW, sums)
        split = np.clip(place - (WINDOW - 2 * FIRST) - begin, 0, many)     # so many of the run lie left
        right, left = many > split, split > 0
        key = np.concatenate([double[place[right]], double[place[left] - FIRST] ^ _LEFT])
        begin = np.concatenate([(begin + split)[right], begin[left]])
        many = np.concatenate([(many - split)[right], split[left]])
        order = np.argsort(begin, kind="stable")
        key, begin, many = key[order], begin[order], many[order]
        edge = np.concatenate([[0], np.cumsum(many)])
        at = np.repeat(begin - edge[:-1], many) + np.arange(edge[-1])      # every full window of the runs
        doc = np.searchsorted(first, at, side="right") - 1
        by = np.lexsort((at, full[at], doc))                               # seen before in the same text
        again = np.zeros(len(at), bool)
        again[by[1:]] = (full[at][by[1:]] == full[at][by[:-1]]) & (doc[by[1:]] == doc[by[:-1]])
        owner = np.searchsorted(first, begin, side="right") - 1
        doc = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [_signed(key), part.column("key").take(doc), part.column("hash").take(doc),
             pa.array((begin - first[owner]).astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(edge, pa.int32()), _signed(full[at])),
             pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(again))],
            names=["h", "key", "hash", "start", "windows", "again"])


def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select(*more, key.alias("key"), F.xxhash64("text").alias("hash"),
                       F.coalesce("text", F.lit("")).alias("text"))


def _repeated(rows: DataFrame) -> DataFrame:
    """Rows whose h another row has too.  The repeated values are written
    first: a join of two plain shuffles is one whose hot values Spark splits."""
    again = pin(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    return rows.join(again, "h", "left_semi")


def _first(rows: DataFrame) -> DataFrame:
    """The smallest key of every h, written first for the same reason."""
    return pin(rows.groupBy("h").agg(F.min("key").alias("first")))


def repeats(docs: DataFrame) -> DataFrame:
    """Later occurrences per text: key, hash, and marks of start * 32 + number
    of consecutive full windows."""
    keyed = _keyed(docs).withColumn("row", F.xxhash64("key", "hash"))
    short = pin(keyed.select("row", "text").mapInArrow(_level_first, "h long, row long, place int"))
    places = pin(_repeated(short).groupBy("row").agg(F.collect_set("place").alias("places")))
    unpin(short)
    double = pin(keyed.join(places, "row").select("key", "hash", "text", "places").mapInArrow(
        _level_second, "h long, key long, hash long, start int, windows array<long>, again array<boolean>"))
    runs = pin(_repeated(double).withColumn("h", F.xxhash64("windows")))
    unpin(double)
    rest = pin(runs.join(_first(runs), "h"))
    unpin(runs)
    settled = rest.where("first < key").select(
        "key", "hash", (F.col("start").cast("long") * 32 + F.size("windows")).alias("mark"))
    single = rest.where("first = key").select("key", "hash", "start", "again", F.posexplode("windows").alias("i", "h"))
    one = _first(single.select("h", "key"))
    alone = single.join(one, "h").where(F.col("first") < F.col("key")).select("key", "hash", "start", "i").union(
        single.where(F.get("again", F.col("i"))).select("key", "hash", "start", "i"))
    marks = settled.union(alone.select("key", "hash", ((F.col("start").cast("long") + F.col("i")) * 32 + 1).alias("mark")))
    return marks.groupBy("key", "hash").agg(F.collect_set("mark").alias("marks"))


def _judged(part: pa.RecordBatch):
    """Per text: words, removed words, kept words joined by one space."""
    data, start, end, first, _ = _words(part)
    n = len(start)
    marks = part.column("marks")
    cover = np.zeros(n + WINDOW + 1, dtype=np.int64)
    value = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = np.diff(marks.offsets.to_numpy()) if marks.null_count == 0 else np.array(
        [len(m) if m is not None else 0 for m in marks.to_pylist()])
    begin = np.repeat(first[:-1], size) + value // 32
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + value % 32 + WINDOW - 1, -1)
    keep = np.cumsum(cover)[:n] == 0
    own = W.owner(first)
    n_words = np.diff(first)
    removed = np.bincount(own[~keep], minlength=len(n_words))
    s, length = start[keep], (end - start)[keep] + 1            # a kept word and one byte for its space
    edge = np.concatenate([[0], np.cumsum(length)])
    at = np.repeat(s - edge[:-1], length) + np.arange(edge[-1])
    at[edge[1:] - 1] = 0
    text = data[at] if len(data) else np.zeros(0, np.uint8)
    text[edge[1:] - 1] = 0x20
    cut = edge[np.concatenate([[0], np.cumsum(n_words - removed)])]
    kept = [text[a:max(a, b - 1)].tobytes() for a, b in zip(cut[:-1], cut[1:])]
    return n_words, removed, kept


def _digest(batches):
    for part in W.slices(batches, "text"):
        n_words, removed, kept = _judged(part)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _with_marks(docs: DataFrame, column: Column, name: str) -> DataFrame:
    marks = pin(repeats(docs))
    return (_keyed(docs, column.alias(name)).join(marks, ["key", "hash"], "left")
            .select(name, "text", F.coalesce("marks", F.array().cast("array<long>")).alias("marks")))


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    rows = _with_marks(docs, F.col("doc_id").cast("long"), "doc_id")
    return rows.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def cleaned(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with text free of repeats and n_chars to match.
    A text without repeats stays as it is (null becomes empty); a row of which
    nothing is left goes."""
    columns = docs.columns
    others = [c for c in columns if c not in ("text", "n_chars")]
    rows = _with_marks(docs, F.struct(*others), "row")          # one column: names may clash with ours

    def run(batches):
        for part in W.slices(batches, "text"):
            _, removed, kept = _judged(part)
            cut = np.flatnonzero(removed)
            texts = part.column("text").to_pylist()
            for i in cut:
                texts[i] = kept[i].decode()
            stay = np.ones(len(texts), bool)
            stay[cut] = [bool(kept[i]) for i in cut]
            out = {**{c: pc.struct_field(part.column("row"), c) for c in others}, "text": pa.array(texts, pa.string())}
            out["n_chars"] = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_pydict({c: out[c] for c in columns}).filter(pa.array(stay))

    return rows.mapInArrow(run, docs.schema)


#: The definition itself: every window of 20 words against its first start.
SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
word AS (
  SELECT doc_id, i, w[i] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS s
  FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT t.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(s, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""
