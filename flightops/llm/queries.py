"""The contract queries opN_<name>: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flightops.llm import (bpe, chat_format, decontam, html_extract, importance, line_dedup, merkle, ngram_join, quality_rules,
                           simhash_dedup, substring_dedup, toxicity, url_filter)
from flightops.llm.common import read


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                      public_tokenizers.PATTERN)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(spark, read(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.digest(read(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(read(spark, sf_dir, "documents"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.digest(read(spark, sf_dir, "documents"))


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.digest(read(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(read(spark, sf_dir, "documents"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(spark, read(spark, sf_dir, "conversations"))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.digest(read(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_quality_rules": op4_quality_rules,
    "op5_line_dedup": op5_line_dedup,
    "op6_decontam": op6_decontam,
    "op7_simhash_dedup": op7_simhash_dedup,
    "op8_html_extract": op8_html_extract,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_chat_format": op10_chat_format,
    "op11_ngram_join": op11_ngram_join,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op4_quality_rules": quality_rules.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op10_chat_format": chat_format.ORACLE,
    "op11_ngram_join": ngram_join.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
