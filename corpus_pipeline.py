"""The corpus pipeline: documents pass the stages one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_benchmark
from tidemark.llm.exact_dedup import keep_first
from tidemark.llm.mixing import WEIGHTS, mix_sources
from tidemark.llm.ngram_join import one_of_each
from tidemark.llm.quality import keep_good
from tidemark.llm.scratch import scratch_path
from tidemark.session import temporary
from tidemark.sinks.folders import remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts stays."""
    return keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their places in the mixture."""
    return mix_sources(docs, WEIGHTS)


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written, and removed after the next one.

    The scratch tables of a stage go as soon as its result is there.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove(spark, before)
        before = path
    return docs


# A trained classifier has no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None
