"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docketmill.llm import (
    chat, decontaminate, fingerprints, language, licenses, mixture, neardup, quality, secrets, sharding, spelling,
    tokenids, whitening)
from docketmill.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_tool_call_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.conversation_calls(table(spark, sf_dir, "conversations"))
    return chat.formatted(calls, results, chat.CONVERSATION_TOOLS)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.report(decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark")))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_files(table(spark, sf_dir, "documents")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenids.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = sharding.SHARDS
    return sharding.placed(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        sharding.equal_shards(n), sharding.equal_shards(n + 1))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_tool_call_links": op4_tool_call_links,
    "op5_source_mix": op5_source_mix,
    "op6_decontaminate": op6_decontaminate,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_token_files": op10_token_files,
    "op11_sharding": op11_sharding,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}
