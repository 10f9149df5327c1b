"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scriptorium.llm import line_dedup, oracles, substring_dedup, url_lists
from scriptorium.llm.common import table
from scriptorium.llm.edit_embedding import fingerprint_digest
from scriptorium.llm.minhash_dedup import near_digest
from scriptorium.llm.mixing import mixing_digest
from scriptorium.llm.packing import pack_documents
from scriptorium.llm.quality import quality_digest
from scriptorium.llm.sharding import sharding_digest
from scriptorium.llm.vector_dedup import vector_digest

Query = Callable[[SparkSession, str], DataFrame]


def op1_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lists.url_lists_report(table(spark, sf_dir, "pages"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_digest(table(spark, sf_dir, "documents"))


def op5_edit_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_digest(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_digest(table(spark, sf_dir, "embeddings"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding_digest(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_url_lists, op2_packing, op3_quality, op4_minhash_dedup, op5_edit_embedding, op6_line_dedup, op7_vector_dedup, op8_substring_dedup, op9_sharding, op10_mixing)}
SQL: dict[str, str] = {
    "op1_url_lists": url_lists.SQL,
    "op4_minhash_dedup": oracles.NEAR_SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op7_vector_dedup": oracles.VECTOR_SQL,
    "op8_substring_dedup": substring_dedup.SQL,
}
