"""One query for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder
from . import bpe, chat, decontaminate, idstore, langid, licenses, quality, reputation, rules, secrets, simhash, target_draw, vectorcodes
from .common import table
from .oracle import SQL

__all__ = ["QUERIES", "SQL"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages share their ids with the labels; low quality is a bad outcome."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(labels["doc_id"].alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return reputation.judge_urls(table(spark, sf_dir, "pages"), outcomes)


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@query
def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


@query
def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
    idstore.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return idstore.read_documents(spark, path)


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)

# A conversation whose texts hold the template's own control strings.
HARD_TURNS = [(-7, turn, role, "\\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


@query
def op11_target_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_draw.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.code_table(table(spark, sf_dir, "embeddings"))


@query
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/chat-{uuid.uuid4().hex}"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame(HARD_TURNS, "conv_id long, turn long, role string, text string"))
    chat.write_conversations(turns, path, ranks, pattern)
    return chat.read_digests(spark, path, ranks, pattern)
