"""The corpus pipeline: quality rules, language ID, line dedup, near-dedup and packing, one after another.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as
the next stage's `docs`. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewire.llm import language, line_templates, minhash, packing, quality
from tidewire.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the default policy."""
    return quality.keep_good(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the model learns from the stage's own input."""
    return language.keep_known(docs, language.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring line templates stay in one document; rows left without a word go."""
    return line_templates.dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]

# Language ID and consistent sampling are no SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
