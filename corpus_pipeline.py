"""A corpus pipeline: each stage works on the documents that the one before it kept.

Null, empty and blank texts, and those too short to judge, go in the first stage. Null ids and repeated rows are handled as each
operator says; further columns, whatever their names, pass through, and the column that the last stage adds takes a free
name. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import jaccard_join, mixing, quality_rules, suffix_dedup, winnowing
from starloom.session import scratch


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group linked by common shingles."""
    return jaccard_join.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings that a document with a smaller id has too."""
    return suffix_dedup.cleaned(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a window of the benchmark."""
    return winnowing.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with a further column ``copy``."""
    return mixing.copied(docs)


STAGES = [
    ("quality_rules", rules),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("winnowing", decontaminate),
    ("mixing", mix),
]

# The votes of the first stage and the rounding of the last are no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage returns, each stage written out and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
