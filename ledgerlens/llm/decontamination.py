"""Benchmark decontamination by size-partitioned MinHash containment search.

Native: DataFrame and SQL functions only.

Texts are sets of hashed word 5-grams.  Benchmark items are partitioned by
size (5-grams, in powers of two); each partition has its own number of MinHash
seeds and of seeds that must agree.  An item's MinHash values are 5-grams of
the item, and each of them lies in a document with a probability equal to the
item's containment there, however long the document is: so the values are
looked up among the document's 5-grams, and a document where enough seeds
agree is a candidate.  Candidates are verified by exact containment: the share
of the item's distinct 5-grams that the document holds.

``SEEDS`` gives the seeds of each partition; the number that must agree is the
largest that misses an item at the threshold with a chance of ``MISS`` or less.

One pass over the documents finds candidates: 5-grams are made and probed in
one stage and only hits are shuffled, as one bit mask per (document, item)
and task.  The tables of items and probes are written first, so that Spark
broadcasts them while their size is under its threshold and joins by shuffle
beyond.

Cases: null texts and texts under five words hold no 5-gram and never match;
items under five words neither; repeated items of one id count as one set;
rows with one doc_id and different texts are judged apart, repeated rows give
one result; a null id takes part like any other; other columns are ignored.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import pin

SIZE = 5
THRESHOLD = 0.8
MISS = 1e-6
SEEDS = ((16, 12), (64, 20), (1 << 62, 28))     # items of up to so many 5-grams: seeds


def agreeing(seeds: int, threshold: float, miss: float = MISS) -> int:
    """Most seeds that may be asked to agree: P(fewer agree) stays under miss."""
    below, need = 0.0, 0
    while need < seeds:
        below += comb(seeds, need) * threshold ** need * (1 - threshold) ** (seeds - need)
        if below > miss:
            break
        need += 1
    return max(1, need)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per 5-gram (``gram``) of the array ``h``."""
    return (rows.where(F.size("h") >= SIZE)
            .select(*keep, "h", F.explode(F.sequence(F.lit(0), F.size("h") - SIZE)).alias("i"))
            .select(*keep, F.xxhash64(*[F.get("h", F.col("i") + k) for k in range(SIZE)]).alias("gram")))


def item_grams(items: DataFrame) -> DataFrame:
    """item_id, gram (distinct), n (of the item)."""
    grams = _grams(items.select("item_id", word_hashes(F.col("text")).alias("h")), "item_id").distinct()
    size = grams.groupBy("item_id").agg(F.count("*").alias("n")).withColumnRenamed("item_id", "of")
    return grams.join(size, F.col("item_id").eqNullSafe(F.col("of"))).drop("of")


def probes(grams: DataFrame, threshold: float) -> DataFrame:
    """gram, item_id, mask (bits of the seeds whose minimum it is), need."""
    sets = grams.groupBy("item_id", "n").agg(F.collect_list("gram").alias("grams"))
    seeds = need = None
    for top, count in reversed(SEEDS):
        here = F.lit(count), F.lit(agreeing(count, threshold))
        seeds, need = here if seeds is None else (F.when(F.col("n") <= top, here[0]).otherwise(seeds),
                                                  F.when(F.col("n") <= top, here[1]).otherwise(need))
    low = F.transform(F.sequence(F.lit(0), seeds - 1), lambda s: F.struct(
        s.alias("seed"), F.array_min(F.transform("grams", lambda g: F.struct(F.xxhash64(g, s).alias("v"), g.alias("gram"))))
        ["gram"].alias("gram")))
    return (sets.select("item_id", need.alias("need"), F.explode(low).alias("p"))
            .groupBy("item_id", "need", "p.gram").agg(F.sum(F.expr("shiftleft(1L, p.seed)")).alias("mask")))


def _holding(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """doc_id, hash (of the text), item_id, n, shared: texts that hold an item,
    each judged by itself where an id repeats."""
    grams = pin(item_grams(items))
    probe = pin(probes(grams, threshold))
    rows = docs.select("doc_id", F.xxhash64("text").alias("hash"), word_hashes(F.col("text")).alias("h"))
    found = pin(_grams(rows, "doc_id", "hash").join(probe, "gram")
                .groupBy("doc_id", "hash", "item_id", "need").agg(F.bit_or("mask").alias("mask"))
                .where(F.bit_count("mask") >= F.col("need")).select("doc_id", "hash", "item_id"))
    # exact containment, in candidate documents only
    spots = found.select(F.col("doc_id").alias("d"), F.col("hash").alias("t")).distinct()
    texts = docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")
    texts = texts.join(spots.hint("merge"), (texts.hash == spots.t) & texts.doc_id.eqNullSafe(spots.d), "left_semi")
    held = _grams(texts.select("doc_id", "hash", word_hashes(F.col("text")).alias("h")), "doc_id", "hash")
    shared = (held.join(grams, "gram").groupBy("doc_id", "hash", "item_id", "n", "gram").agg(F.lit(1).alias("one"))
              .groupBy("doc_id", "hash", "item_id", "n").agg(F.count("*").alias("shared")))
    pairs = found.select(F.col("doc_id").alias("d"), F.col("hash").alias("t"), F.col("item_id").alias("q"))
    return (shared.where(F.col("shared") >= F.lit(threshold) * F.col("n"))
            .join(pairs, (F.col("hash") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d"))
                  & F.col("item_id").eqNullSafe(F.col("q")), "left_semi"))


def search(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, n_shingles (of the item), n_shared, containment (at the
    threshold or above)."""
    return (_holding(docs, items, threshold)
            .groupBy("doc_id", "item_id").agg(F.max("n").alias("n_shingles"), F.max("shared").alias("n_shared"))
            .withColumn("containment", F.col("n_shared") / F.col("n_shingles")))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text holds no item, judged row by row (by id
    and text)."""
    gone = pin(_holding(docs, items, threshold)
               .select(F.col("doc_id").alias("gone"), F.col("hash").alias("gone_text")).distinct())
    return docs.join(gone.hint("merge"), (F.xxhash64(docs.text) == gone.gone_text) & docs.doc_id.eqNullSafe(gone.gone),
                     "left_anti")


#: Exact containment over all pairs that share a 5-gram; the search misses one
#: in a million of pairs at the threshold.
SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id)
SELECT doc_id, item_id, n_shingles, count(*) AS n_shared, count(*) / n_shingles AS containment
FROM ds JOIN bs USING (g) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_shingles HAVING count(*) >= 0.8 * n_shingles
"""
