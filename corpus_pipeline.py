"""Corpus cleaning in stages; each works on all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes each
stage's rows to the shared folder and hands the reread table to the next one. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meterloom.llm import bpe, decontaminate, rules, secrets, simhash
from meterloom.llm.common import table
from meterloom.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    return rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its bytes."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("byte_level_bpe", tokens),
]

# XXH64 fingerprints, edit distances inside texts and BPE are not SQL; the tests compare
# every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
