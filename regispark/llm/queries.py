"""Registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regispark.llm import (
    chat_format, decontaminate, filter_audit, inner_product, language_id, mixing, near_dedup, secret_scan, simhash, substring_dedup,
    token_counts, url_filter, vector_codes)
from regispark.llm.common import table


def op1_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_documents(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_product.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = chat_format.with_probe(table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_conversations(chats))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.find_secrets(docs, secret_scan.train(spark, secret_scan.ordinary_words(docs)))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_curriculum_mix, op2_substring_dedup, op3_url_filter, op4_language_id, op5_decontaminate, op6_inner_product, op7_chat_format,
    op8_token_counts, op9_secret_scan, op10_near_duplicates, op11_simhash, op12_vector_codes, op13_filter_audit)}

#: The others fit models, follow links or call a tokenizer; tests/llm holds them against brute force.
ORACLE_SQL = {
    "op1_curriculum_mix": mixing.oracle(), "op3_url_filter": url_filter.oracle(),
    "op6_inner_product": inner_product.oracle(), "op7_chat_format": chat_format.oracle(),
    "op12_vector_codes": vector_codes.oracle(), "op13_filter_audit": filter_audit.oracle()}
