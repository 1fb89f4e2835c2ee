"""A corpus pipeline: one dealt operator per stage, each stage written as Parquet and read again as the next one's docs.

Documents that a stage rejects are gone for all later ones; every stage but the last returns the columns of
``documents``, and the last one the words that the mix takes of each document left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hindcast.llm.common import settled, table
from hindcast.llm.cube_mixing import mix
from hindcast.llm.decontaminate import without_leaks
from hindcast.llm.fertility import kept_by_fertility
from hindcast.llm.order_minhash import one_per_class
from hindcast.llm.quality_kernel import kept_by_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as good."""
    return kept_by_quality(docs, table(spark, sf_dir, "labels"))


def fertility(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside the fertility band of their language."""
    return kept_by_fertility(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return one_per_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document left."""
    return mix(docs)


STAGES = [
    ("quality classifier", quality),
    ("quality rules", fertility),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
]

# SQL can express neither the classifier nor the tokenisers, sketches and samples; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
