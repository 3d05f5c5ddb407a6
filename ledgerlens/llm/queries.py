"""The operators as queries over the driver tables: each with its
production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (context_mixing, decontamination, fingerprint, language_id, license_scan, ngram_join, packing, prefix_trie,
               quality, substring_dedup, toxicity, url_filter, vafile)
from .store import held_out, table


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), encode_special_tokens=False)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.labelled_table(spark))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out("doc_id", 4, 2))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out("doc_id", 5, 0))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"), held_out("doc_id", 4, 2))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(table(spark, sf_dir, "documents"), held_out("doc_id", 10, 0))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.cluster(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_ngram_jaccard_join, op3_document_fingerprints, op4_packing, op5_substring_dedup,
    op6_url_filters, op7_toxicity, op8_quality_classifier, op9_language_id, op10_lm_scoring,
    op11_prefix_trie, op12_license_scans, op13_centroid_clustering)}

#: Only what SQL expresses; the other queries are tested against brute force.
ORACLE_SQL = {"op1_benchmark_decontamination": decontamination.SQL, "op2_ngram_jaccard_join": ngram_join.SQL,
              "op5_substring_dedup": substring_dedup.SQL, "op11_prefix_trie": prefix_trie.SQL, "op12_license_scans": license_scan.SQL,
              "op13_centroid_clustering": vafile.SQL}
