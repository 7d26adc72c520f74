"""Training-corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on every document that
the stage before kept; its result is written as Parquet and read again.  All
but the last return the columns of ``documents``.

Empty tables, nulls, repeated rows and columns beyond those of ``documents``
are treated as the stage's operator says in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm import bin_packing, decontaminate, ngram_join, quality_rules, substring_dedup
from stratum.llm.stage import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject."""
    return quality_rules.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves the document with the least id of each group."""
    return ngram_join.one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages out that an earlier document has; a document of which nothing is left goes."""
    return substring_dedup.without_passages(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark item stands."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents that are left, with its place in a sequence."""
    return bin_packing.best_fit_packing(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", passages),
    ("benchmark_decontamination", benchmark_passages),
    ("best_fit_packing", packing),
]

#: Edit matching, chaining and tokenizing are beyond SQL: ``tests/llm/test_corpus_pipeline.py`` compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
