"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wxspark.llm import (
    byte_bpe,
    chat,
    decontaminate,
    divergence,
    language,
    licences,
    line_rules,
    near_duplicates,
    piece_bpe,
    quality,
    token_records,
    toxicity,
    vector_codes,
)
from wxspark.llm.common import table
from wxspark.llm.oracles import ORACLES as ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_records.write_records(docs, public_tokenizers.path("word_bpe_49k.json"))
    return token_records.record_table(spark, files)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "conversations")
    return chat.turns(messages, chat.learn(messages))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_table(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_table(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.rule_table(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digest_table(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.grouped(table(spark, sf_dir, "documents"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_table(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.language_table(docs, language.learn(language.learnable(docs)))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_table(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digest_table(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_token_records": op1_token_records,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_decontamination": op4_decontamination,
    "op5_line_rules": op5_line_rules,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_licences": op8_licences,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_divergence": op12_divergence,
    "op13_piece_bpe": op13_piece_bpe,
}
