"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor
kept and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``.  All but the last return the columns of documents.

Nulls, empty and very long texts, repeated rows, empty tables and extra columns
have the results that the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, mixing, quality, sharding, simhash
from tessera.llm.common import bounded_batches, staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are depleted by their hosts' frequent lines go."""
    bounded_batches(spark)
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    bounded_batches(spark)
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    bounded_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated, cut or left out so that each source meets its target."""
    bounded_batches(spark)
    return mixing.mixed(docs)


def placement(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its slot and shard."""
    return sharding.place(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing_to_targets),
    ("sharding", placement),
]

#: SQL has no XXH64 for the fingerprints; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-').lower()}")
    return docs
