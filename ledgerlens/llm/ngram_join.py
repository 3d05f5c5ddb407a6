"""N-gram Jaccard join by MinHash banding.

Texts are sets of word 5-grams.  Their MinHash signatures are cut into bands;
texts that share a band meet.  A common passage can make unrelated texts meet,
so those that meet are compared by sketches first (the smallest n-gram hash of
each of ``BINS`` bins, a byte each): pairs whose estimate lies four deviations
under the threshold are no candidates.  What is left is linked to connected
groups of candidates.  All pairs among them are verified on full n-gram sets,
in square blocks of ``BLOCK`` texts, as matrix products: what leaves a block
is one row per text (its number of links, the smallest text it is linked
with), never its pairs.  Texts that meet are compared in such blocks too, so a
band that many texts share is dealt over many tasks.

Equal texts are one node throughout, so copies are never expanded; the links
of a node count for each of its copies.

``banding`` picks bands and rows for a target recall at the threshold.

Cases: a text of fewer than five words is one n-gram of all its words; a text
without words (null, empty, only marks) is alone in its class; a null doc_id
takes part but names a class only if no member has an id; rows that repeat
an id and text count as copies; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .graph import components
from .store import pin

SIZE = 5
THRESHOLD = 0.8
RECALL = 0.9999     # chance that a pair at the threshold shares a band
HASHES = 80         # MinHash values at most
BLOCK = 512         # texts on one side of a block
BINS = 256          # bytes of a sketch


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows that reach the recall within the hashes."""
    for rows in range(16, 0, -1):
        bands = 1 if threshold >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= hashes:
            return bands, rows
    raise ValueError("no banding reaches this recall with so few hashes")


def ngrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams (with repeats) and each text's first one (n + 1)."""
    start, end, first = W.find(data, offs, W.ALNUM)
    h = W.hashes(W.LOWER[data], start, end)
    n_words = np.diff(first)
    inside = np.flatnonzero(W.whole(first, len(h), SIZE))
    grams = W.windows(h, SIZE)[inside]
    own = np.searchsorted(first, inside, side="right") - 1
    short = np.flatnonzero((n_words > 0) & (n_words < SIZE))
    if len(short):
        sums, down = W.word_sums(h)
        a, b = first[short], first[short + 1]
        one = W.mix((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) + np.uint64(1 << 40))
        own, grams = np.concatenate([own, short]), np.concatenate([grams, one])
        order = np.argsort(own, kind="stable")
        own, grams = own[order], grams[order]
    return grams, np.searchsorted(own, np.arange(len(offs)))


def sketches(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of bytes per text: of each bin the smallest hash that falls into
    it, by 255 values; 0 for none."""
    low = np.full((len(first) - 1) * BINS, W.MAX_U64)
    h = W.mix(grams ^ np.uint64(0x2545F4914F6CDD1D))
    np.minimum.at(low, W.owner(first) * BINS + (h >> np.uint64(56)).astype(np.int64), h)
    return np.where(low == W.MAX_U64, 0, 1 + low % np.uint64(255)).astype(np.uint8).reshape(-1, BINS)


def least_estimate(threshold: float) -> float:
    """What the sketches of a pair at the threshold agree on at least, but for
    one pair in thirty thousand."""
    return threshold - 4 * math.sqrt(threshold * (1 - threshold) / BINS)


def _signatures(bands: int, rows: int):
    rng = np.random.default_rng(20_240_229)
    flips = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64)
    factors = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches):
        for part in W.slices(batches, "text"):
            grams, first = ngrams(*W.column_bytes(part.column("text")))
            many = np.diff(first)
            have = np.flatnonzero(many)
            key = np.zeros((bands, len(have)), np.uint64)
            if len(have):
                at = first[have]
                for b in range(bands):
                    for r in range(b * rows, (b + 1) * rows):
                        low = np.minimum.reduceat((grams ^ flips[r]) * factors[r], at)
                        key[b] = W.mix(key[b] * np.uint64(0x100000001B3) + low + np.uint64(b))
            edge = np.concatenate([[0], np.cumsum(np.where(many > 0, bands, 0))])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("node"), pa.array(many, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(key.T.ravel().view(np.int64))),
                 pa.array([x.tobytes() for x in sketches(grams, first)], pa.binary())],
                names=["doc_id", "node", "n", "bands", "sketch"])
    return run


def _lowest(linked: np.ndarray) -> np.ndarray:
    """Of each row the first one it is linked to, directly or through others."""
    np.fill_diagonal(linked, True)
    root = np.arange(len(linked))
    while True:
        low = np.array([root[linked[k]].min() for k in range(len(linked))])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def like_pairs(sketch: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sketches may reach the threshold.  One bit of each byte
    first, as a matrix product (agreeing less differing bins, on average the
    equal ones); then all bytes of the pairs left."""
    full = sketch > 0
    sign = np.where(full, (sketch & 1) * 2.0 - 1, 0).astype(np.float32)
    size = full.sum(axis=1)
    held = full.astype(np.float32)
    union = size[:, None] + size[None, :] - held @ held.T
    may = sign @ sign.T >= threshold * union - 4 * np.sqrt((1 - threshold ** 2) * union)
    a, b = np.nonzero(np.triu(may, 1))
    linked = np.zeros(may.shape, bool)
    for at in range(0, len(a), 1 << 15):
        x, y = a[at:at + (1 << 15)], b[at:at + (1 << 15)]
        same = ((sketch[x] == sketch[y]) & full[x]).sum(axis=1) >= least_estimate(threshold) * union[x, y]
        linked[x[same], y[same]] = linked[y[same], x[same]] = True
    return linked


def _alike(threshold: float):
    """Texts of a block that share a band, each with the first one it is like
    by their sketches; rows come sorted by block."""
    def groups(rows: pa.RecordBatch, last: bool):
        keys = [rows.column(c).to_numpy() for c in ("band", "i", "j")]
        new = np.ones(rows.num_rows, bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        lead = np.append(np.flatnonzero(new), rows.num_rows)
        if not last:
            lead = lead[:-1]                     # the last one may go on
        node = rows.column("node").to_numpy()
        sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        found = []
        for a, z in zip(lead[:-1], lead[1:]):
            if z - a > 1:
                root = a + _lowest(like_pairs(sketch[a:z], threshold))
                at = np.flatnonzero(root != np.arange(a, z))
                found.append((node[a:z][at], node[root[at]]))
        out = pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *[f[k] for f in found]])) for k in (0, 1)],
                                         names=["a", "b"])
        return out, rows.slice(lead[-1]) if len(lead) else rows

    def run(batches):
        rest = None
        for b in batches:
            if b.num_rows:
                out, rest = groups(pa.concat_batches([rest, b]) if rest is not None else b, False)
                yield out
        if rest is not None:
            yield groups(rest, True)[0]
    return run


def _verify(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, pick = np.unique(rows["node"].to_numpy(), return_index=True)      # repeated rows once
        rows = rows.take(pa.array(pick))
        side = rows["side"].to_numpy()
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        copies = rows["copies"].to_numpy().astype(float)
        grams, first = ngrams(*W.column_bytes(rows["text"]))
        own = W.owner(first)
        term, at = np.unique(grams, return_inverse=True)
        pair = np.unique(own * max(1, len(term)) + at)                           # sets: each n-gram once
        own, at = pair // max(1, len(term)), pair % max(1, len(term))
        n = np.bincount(own, minlength=len(node)).astype(float)
        shared = np.bincount(at, minlength=len(term)) > 1
        keep = shared[at]
        own, at = own[keep], (np.cumsum(shared) - 1)[at[keep]]
        both = np.zeros((len(node), len(node)), np.float32)
        order = np.argsort(at, kind="stable")
        own, at = own[order], at[order]
        for c in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(at, c), np.searchsorted(at, c + 4096)
            m = np.zeros((len(node), min(4096, int(shared.sum()) - c)), np.float32)
            m[own[lo:hi], at[lo:hi] - c] = 1
            both += m @ m.T
        linked = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-6
        linked &= (n > 0)[:, None] & (n > 0)[None, :]
        if i != j:
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        links = (linked @ copies).astype(np.int64)
        root = _lowest(linked)
        return pa.table({"node": node, "links": links, "root": node[root]})
    return run


def _classes(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """A row for each document: doc_id, node (hash of its text), class_id,
    n_links, and for texts with words copies (rows of that text) and lead (the
    class's smallest node)."""
    bands, rows = banding(threshold, recall)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("node"), "text")
    signed = pin(texts.mapInArrow(_signatures(bands, rows), "doc_id long, node long, n long, bands array<long>, sketch binary"))
    nodes = pin(signed.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")))
    # texts that share a band, in square blocks
    keys = nodes.select("node", F.explode(F.array_distinct("bands")).alias("band"))
    shared = (keys.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
              .select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    # sketches join what is left: most bands are one text's alone (one plan at every size, as below)
    met = (keys.join(pin(shared).hint("merge"), "band").join(nodes.select("node", "sketch").hint("merge"), "node")
           .withColumn("side", F.pmod(F.xxhash64("node", "band"), F.col("blocks")).cast("int"))
           .select("band", "node", "sketch", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
           .select("band", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "sketch"))
    alike = met.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(
        _alike(threshold), "a long, b long")
    met = components(alike.distinct())
    nodes = nodes.drop("bands", "sketch")
    member = pin(met.join(nodes, "node"))
    size = member.groupBy("root").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    member = member.join(size, "root").withColumn("side", F.pmod(F.xxhash64("node", "root"), F.col("blocks")).cast("int"))
    # one row of each text, sent to every square of its candidates that needs it
    # (texts move at every size: how many of them are candidates is not known before)
    member = member.hint("merge")
    squares = (texts.join(member, (texts.node == member.node) & texts.doc_id.eqNullSafe(member["first"]))
               .select(member.node, "root", "side", "copies", "text",
                       F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
               .select("node", "root", "side", "copies", "text", F.least("side", "other").alias("i"),
                       F.greatest("side", "other").alias("j")))
    checked = pin(squares.groupBy("root", "i", "j").applyInArrow(_verify(threshold), "node long, links long, root long"))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    linked = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    grouped = nodes.join(linked, "node", "left").withColumn("root", F.coalesce("root", "node"))
    name = grouped.groupBy("root").agg(F.min("first").alias("class_id"), F.min("node").alias("lead"))
    per_node = grouped.join(name, "root").join(links, "node", "left").select(
        "node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "copies", "lead")
    return signed.where("n > 0").select("doc_id", "node").join(per_node, "node").select(
        "doc_id", "node", "class_id", "n_links", "copies", "lead").union(
        signed.where("n = 0").select("doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                     F.lit(None).cast("long").alias("copies"), F.lit(None).cast("long").alias("lead")))


def join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (smallest id among linked documents, directly or through
    others) and n_links (documents at the threshold or above)."""
    return _classes(docs, threshold, recall).select("doc_id", "class_id", "n_links")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id names their class, judged row by row (by
    id and text); of a class without an id one row, of the smallest text hash."""
    nameless = F.col("class_id").isNull() & F.col("lead").isNotNull()
    alone = (F.col("node") == F.col("lead")) & (F.col("copies") == 1)
    judged = pin(_classes(docs, THRESHOLD, RECALL)
                 .where(~F.col("doc_id").eqNullSafe(F.col("class_id")) | nameless & ~alone)
                 .select(F.col("doc_id").alias("gone"), F.col("node").alias("gone_text"),
                         (nameless & (F.col("node") == F.col("lead"))).alias("back")).distinct())
    text = F.xxhash64(docs.text)
    kept = docs.join(judged.hint("merge"), (text == judged.gone_text) & docs.doc_id.eqNullSafe(judged.gone), "left_anti")
    # equal rows without an id: all went, one of them comes back
    back = (docs.where(docs.doc_id.isNull()).join(judged.where("back"), text == F.col("gone_text"), "left_semi")
            .groupBy(F.xxhash64("text").alias("text_hash"))
            .agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("kept_row")).select("kept_row.*"))
    return kept.union(back)


#: The definition itself: all pairs that share an n-gram, and what their links reach.
SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^0-9a-z\x{80}-\x{10FFFF}]+'), lambda x: x <> '') AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM t WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
link AS (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
named AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
linked AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN named ON named.a = doc_id LEFT JOIN linked ON linked.a = doc_id
"""
