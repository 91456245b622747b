"""Cleaning pipeline over the documents table.

Each stage takes the rows that the one before has kept, and all but the last give the columns of
``documents``: language identification drops the documents that it rejects, quality rules those that
they reject, near-duplicates keep one document of each group, repeated passages are cut from the texts
and what is left is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from landfall.llm import language_id, paragraph_dedup, quality_rules, simhash_dedup, vector_packing
from landfall.llm.common import written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the labelled rows of its own input."""
    return language_id.keep_known(docs, language_id.fit(docs))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return paragraph_dedup.cut_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vector_packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("simhash_dedup", one_of_each_group),
    ("paragraph_dedup", without_repeats),
    ("vector_packing", packed),
]

#: No SQL: the language model, fingerprints and tokenizers can't be put in it. Tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
