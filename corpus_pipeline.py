"""A training corpus in five stages; each works on what the one before has kept.

Quality rules reject documents and take boilerplate lines out of the others. Of each group of
near duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest id
stays. Documents that hold a benchmark item go. Secrets are masked. What is left is packed into
sequences of at most 1024 tokens.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontamination, jaccard, packing, quality, secrets
from basketry.llm.tables import documents, stored
from basketry.session import prepare

SHINGLE_WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, **quality.PIPELINE_LIMITS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, SHINGLE_WORDS, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs, single_case_bits=secrets.SINGLE_CASE_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, vocabulary, payload="ids_crc32")


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("packing", pack),
]

# Packing counts tokens of a byte-pair vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(prepare(spark), sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
