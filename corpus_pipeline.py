"""A training corpus from raw documents, in five stages.

``run(spark, sf_dir)`` applies the stages to the ``documents`` table in order;
each stage's result is written as Parquet in the checkpoint folder and reread
as the next one's input.  All stages but the last return whole documents in
the columns of ``documents``; what a stage decides about a row holds for the
stages after it:

1. toxicity: rows with a score of 0.3 or more go; labels teach from rows whose
   crc32(doc_id as text) mod 4 is not 2;
2. n-gram Jaccard join: of each group of linked rows the one with the smallest
   doc_id stays (rows of the group that repeat that id stay together); of a
   group without ids one row stays;
3. substring dedup: later occurrences of 20 consecutive words are cut out of
   the texts; a text without any stays as it is, an emptied one goes;
4. benchmark decontamination: rows that hold a benchmark item go;
5. packing: the remaining texts become pieces of 1024-token sequences.

Null and empty texts pass stages 1 to 4 and are packed as their end id; null
ids, repeated rows, extra columns and empty tables are treated as each
operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import decontamination, ngram_join, packing, substring_dedup, toxicity
from ledgerlens.llm.store import held_out, pin, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.select(*COLUMNS)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id", 4, 2)))
    return toxicity.predict(docs, model, *COLUMNS).where("predicted = 0").select(*COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs.select(*COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.cleaned(docs.select(*COLUMNS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs, encode_special_tokens=False)


STAGES = [("toxicity", without_toxic), ("ngram_jaccard_join", without_near_copies),
          ("substring_dedup", without_repeats), ("benchmark_decontamination", without_benchmark),
          ("packing", packed)]

#: Classifier, hashing tokenizer and packing have no SQL form; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
