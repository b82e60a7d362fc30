"""The operators on the benchmark tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from entitylake.llm import ann, centroids, html, langid, licenses, merkle, mixing, packing, quality, simhash, substrings, token_counts, vectors
from entitylake.llm.sql import ORACLES

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trusted_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that the labels call good."""
    return table(spark, folder, "labels").where("quality = 1").select("doc_id")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extracted(table(spark, folder, "pages"))
    return found.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), BYTE_BPE)


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.without_repeats(table(spark, folder, "documents"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents")).select(
        "row.doc_id", "size", "source_size", "target", "taken"
    )


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scanned(table(spark, folder, "documents"))
    return found.select("row.doc_id", "license", "dice", F.array_join("licenses", ";").alias("licenses"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.identified(docs, langid.fitted(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ratios = quality.likelihood_ratios(docs, trusted_ids(spark, folder))
    return quality.judged(docs, ratios).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), PIECES)


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, folder, "embeddings"))


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(table(spark, folder, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audited(table(spark, folder, "documents"))


def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_html_extraction": op2_html_extraction,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_source_mixing": op5_source_mixing,
    "op6_license_scan": op6_license_scan,
    "op7_language_id": op7_language_id,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

__all__ = ["ORACLES", "QUERIES"]
