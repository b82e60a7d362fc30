"""The corpus pipeline: from raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from entitylake.llm import mixing, packing, quality, simhash, substrings
from entitylake.llm.batches import share_code
from entitylake.llm.queries import BYTE_BPE, table, trusted_ids
from entitylake.session import materialized


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return quality.good_only(docs, trusted_ids(spark, sf_dir))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in repeated passages go; every document stays, if only as an empty text."""
    return substrings.cleaned(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them."""
    return mixing.rows_of_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.packed(docs, BYTE_BPE)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# Fingerprints by XXH64, suffix trees and token ids have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what a stage returns is written and read again for the next."""
    share_code(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
