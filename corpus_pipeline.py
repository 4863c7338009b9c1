"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, token output.

Each stage takes what its predecessor kept, written as Parquet and read again,
and all but the last return the columns of ``documents``.

Texts that are NULL or have under 50 words end with the quality rules; very
long ones are measured, hashed, searched and encoded whole. Rows that share a
doc_id are documents of their own; of equal rows near-dedup keeps one. NULL
source and lang are groups of their own, NULL doc_id comes first in the token
files. Other columns, of whatever names, are passed through up to the last
stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import decontaminate, mixing, quality, simhash, token_files
from paylake.llm.common import read_table, staged

# The near-dedup operator's contract: words of a shingle, bits that may differ.
SHINGLE, DISTANCE = 3, 3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the adaptive thresholds."""
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return simhash.drop_near_duplicates(docs, SHINGLE, DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every passage of the benchmark cut out."""
    return decontaminate.remove_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them."""
    return mixing.mix(docs).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold per document."""
    return token_files.op5_token_output(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("token_output", token_output),
]

# Fingerprints, seeded draws and token ids are not expressible in SQL; the
# tests hold the stages against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; one row per document of the mix."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
