"""Queries over the test tables, one for each operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderline.llm import centroids, conversation_trie, decontamination, language_id, line_dedup, mixing, quality_rules, secret_scan, token_counts, toxicity, warc
from tenderline.llm.near_dedup import near_duplicates
from tenderline.llm.suffix_dedup import repeated_bytes


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, folder, "documents"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(table(spark, folder, "pages"))
    return warc.page_records(warc.read_archives(spark, archives, with_payload=False))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.severity(docs, toxicity.fit(toxicity.graded(table(spark, folder, "labels"), docs)))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = line_dedup.without_duplicate_lines(table(spark, folder, "documents"))
    return lines.select("doc_id", "n_lines", "n_kept", F.md5("text").alias("kept_md5"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language_id.fit(docs.where(~language_id.held_out("doc_id")))
    found = language_id.languages(docs, model)
    return found.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), shingle_words=4)


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality(table(spark, folder, "documents"))


def op10_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_bytes(table(spark, folder, "documents")).drop("starts", "ends")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, folder, "conversations"))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clusters_of(table(spark, folder, "embeddings"))


def op13_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_decontamination,
        op3_warc,
        op4_toxicity,
        op5_line_dedup,
        op6_token_counts,
        op7_language_id,
        op8_minhash,
        op9_quality_rules,
        op10_suffix_array,
        op11_prefix_trie,
        op12_centroids,
        op13_secrets,
    )
}
CHECKS = {"op1_mixing": mixing.SQL, "op2_decontamination": decontamination.SQL, "op3_warc": warc.SQL, "op5_line_dedup": line_dedup.SQL, "op11_prefix_trie": conversation_trie.SQL, "op12_centroids": centroids.SQL}
