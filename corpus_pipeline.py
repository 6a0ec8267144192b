"""The corpus pipeline: each stage works on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from covtab.llm import exact_dedup, pattern_packing, quality_rules, secret_scan, simhash
from covtab.llm.common import cut_lineage, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate group."""
    return simhash.keep_representatives(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts covered."""
    return secret_scan.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each piece of each document in the packed sequences."""
    return pattern_packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: The later stages cannot be written in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents."""
    docs = read_table(spark, sf_dir, "documents")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = cut_lineage(docs)
    return docs
