"""From raw documents to packed training sequences, in stages that each read what the one before kept.

Every stage is one operator of ``tierflow.llm``. ``STAGES`` lists them; ``run`` applies them to the documents
table, writing each result as Parquet to the shared folder and reading it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierflow.llm import decontamination, language_unigram, packing, private_terms, simhash_golay
from tierflow.llm.common import staged

#: The result depends on trained models and a tokenizer, which SQL does not have; tests/llm holds it against a plain version.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which no language is predicted go: those without letters."""
    return language_unigram.recognised(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash_golay.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, and the terms that disclose it, are replaced in the texts."""
    return private_terms.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, by sequence and offset."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("pii", without_personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
