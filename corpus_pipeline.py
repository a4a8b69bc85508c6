"""A corpus pipeline over ``documents``: language, near-duplicates, benchmark
passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one
before kept. All but the last return the columns of ``documents``. Each result is
written as Parquet into the shared scratch folder and read again as the next
stage's input, so a lost executor costs at most its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import decontamination, jaccard_join, language_kernel, packing, pii
from barloom.llm.common import table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learned languages, go."""
    return language_kernel.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar word shingles the one with the least id stays."""
    return jaccard_join.keep_one_per_component(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; from the others stray benchmark windows are cut."""
    return decontamination.remove_contamination(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are generalised."""
    return pii.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("packed", packed),
]

#: The kernel model, the join and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
