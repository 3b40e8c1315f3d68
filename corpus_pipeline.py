"""From raw documents to token ids in five stages.

Every stage takes all its predecessor kept: quality rules drop documents, one
document of each near-duplicate group stays, secrets in the texts are masked,
sources are mixed to their target weights (a row per copy taken), and the
texts are encoded by a byte-level BPE vocabulary.  ``run`` writes each stage's
result to the shared folder and rereads it for the next one.

The last two stages are beyond SQL, so there is no oracle; the tests hold the
pipeline against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyline.llm import bpe, minhash_dedup, mixing, quality_rules, secret_scans
from tallyline.llm.common import read, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scans.mask(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_duplicates),
    ("secret_scans", secrets),
    ("source_mixing", mixture),
    ("byte_bpe", encoding),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
