"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import (
    bin_packing,
    bpe_transducer,
    chat_format,
    collocations,
    decontaminate,
    hard_negatives,
    language_id,
    license_scan,
    ngram_join,
    oracle,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_packing,
)
from stratum.llm.stage import table


def op1_bfd_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_packing.packed_matrices(table(spark, sf_dir, "documents"))


def op2_empirical_bayes_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host: the document's source.  Path: its part of the source in one language."""
    path = F.concat_ws("/", "source", "lang")
    return quality_classifier.quality_posteriors(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), F.col("source"), path)


def op3_adaptive_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op4_family_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents"))


def op5_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_license_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op8_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.fuzzy_passages(table(spark, sf_dir, "documents"))


def op9_event_sourced_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.formatted(chat_format.conversation_events(rows)))


def op10_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.best_fit_packing(table(spark, sf_dir, "documents"))


def op11_toivonen_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_transducer.encoded_documents(table(spark, sf_dir, "documents"))


def op13_angular_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of rows whose id 7 divides are moved on first; anchors are the rows whose id 100 divides."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {f.__name__: f for f in (
    op1_bfd_token_matrices, op2_empirical_bayes_quality, op3_adaptive_quality_rules, op4_family_language_id,
    op5_pigeonhole_decontamination, op6_ngram_jaccard_join, op7_license_set_join, op8_collinear_passages,
    op9_event_sourced_chat, op10_large_item_packing,
    op11_toivonen_collocations, op12_transducer_bpe, op13_angular_hard_negatives)}
SQL: dict[str, str] = {
    "op3_adaptive_quality_rules": oracle.quality_rules(), "op6_ngram_jaccard_join": oracle.ngram_join(),
    "op7_license_set_join": oracle.license_scan(), "op9_event_sourced_chat": chat_format.ORACLE,
    "op11_toivonen_collocations": collocations.oracle(), "op13_angular_hard_negatives": hard_negatives.oracle()}
