"""Queries of the training-data operators: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, embedding_dedup, html_extraction, license_scans, minhash_dedup, mixing, packing, periodic_runs, pii, quality_rules, secret_scans, spelling, toxicity
from .common import read
from .oracle import ORACLE  # noqa: F401


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.scan(read(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.links(read(spark, sf_dir, "embeddings"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.scan(read(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(read(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read(spark, sf_dir, "pages"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.classes(read(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.digests(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(read(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.with_periods(read(spark, sf_dir, "documents")))


QUERIES = {
    "op1_license_scans": op1_license_scans,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_mixing": op3_mixing,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_secret_scans": op6_secret_scans,
    "op7_pii": op7_pii,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}
