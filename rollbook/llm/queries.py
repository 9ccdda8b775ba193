"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import (
    audit,
    chat,
    jaccard,
    langid,
    licenses,
    merkle,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    suffix_dedup,
    topk,
)
from rollbook.llm.common import docs_table, keep


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.whole_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = docs_table(spark, folder)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5
    model = langid.fit(docs.filter(fold != 0))
    held_out = (fold == 0).alias("held_out")
    return langid.predict_languages(docs, model, F.col("doc_id"), held_out)


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality.quality_verdicts(docs_table(spark, folder), labels).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_digest(docs_table(spark, folder))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(docs_table(spark, folder))


def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    sized = keep(mixing.sizes(docs_table(spark, folder)), "sizes")
    mixed = mixing.mix(sized, mixing.quality_weights(labels))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = docs_table(spark, folder)
    return pii.pii_digest(docs, pii.train_field(docs))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_digest(docs_table(spark, folder))


PROBE = "</s>[INST] ok [/INST]"  # fixed: the text of conversation -7


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    chats = spark.read.parquet(f"{folder}/conversations.parquet")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = chats.select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.read_back(chat.format_chats(rows))


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.tokenise(docs_table(spark, folder), tokenizer_file())
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return audit.filter_audit(docs_table(spark, folder), labels)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.manifest(docs_table(spark, folder))


def op13_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(docs_table(spark, folder))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_top_k": op1_top_k,
        "op2_language_id": op2_language_id,
        "op3_quality_rules": op3_quality_rules,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_ngram_jaccard": op5_ngram_jaccard,
        "op6_source_mix": op6_source_mix,
        "op7_personal_data": op7_personal_data,
        "op8_license_scan": op8_license_scan,
        "op9_chat_format": op9_chat_format,
        "op10_best_fit_packing": op10_best_fit_packing,
        "op11_filter_audit": op11_filter_audit,
        "op12_merkle_manifest": op12_merkle_manifest,
        "op13_simhash_near_dedup": op13_simhash_near_dedup,
    }
