"""The registered queries of this subpackage and the SQL that states the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe_codec, chat_format, decontaminate, exact_dedup, importance, langid, license_scan, mixing, ngram_join, quality,
    token_alignment, url_reputation, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on the driver's machine."""
    from public_tokenizers import path

    return path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_reputation.judge_urls(_table(spark, sf_dir, "pages"), outcomes, url_reputation.RULES)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = chat_format.PROBE
    extra = spark.sql(
        f"SELECT * FROM VALUES (-1L, 0L, 'user', '{probe}'), (-1L, 1L, 'assistant', '{probe}') AS t(conv_id, turn, role, text)")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.chat_digests(rows.unionByName(extra))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return rows.withColumnRenamed("digest", "text_sha256")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"), mixing.WEIGHTS)
    return mixed.select("doc_id", *mixing.RESULTS)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_digests(
        _table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digests(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {q.__name__: q for q in (
    op1_license_scan, op2_ngram_join, op3_url_reputation, op4_chat_format, op5_decontaminate, op6_quality,
    op7_exact_dedup, op8_warc, op9_mix_sources, op10_language, op11_token_alignment, op12_bpe_codec,
    op13_importance_resampling)}
ORACLE = {
    "op2_ngram_join": ngram_join.SQL,
    "op3_url_reputation": url_reputation.SQL,
    "op4_chat_format": chat_format.SQL,
    "op5_decontaminate": decontaminate.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op8_warc": warc.SQL,
    "op9_mix_sources": mixing.SQL,
}
