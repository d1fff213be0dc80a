"""Corpus preparation in five stages, each over all its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Empty tables, null texts and extra columns pass through as the
operators define; a document without text has no letter and goes in the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallymark.llm import decontamination, language_id, line_dedup, near_duplicates, packing, texts
from tallymark.session import written_once

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language classifier doesn't reject."""
    texts.small_batches(spark)
    return language_id.of_known_language(docs)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated runs of lines."""
    return line_dedup.without_repeated_lines(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_duplicates.without_near_duplicates(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training sequences."""
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("lines", unrepeated_lines),
    ("near_duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

# A trained classifier decides in the first stage, and ids come from a tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_once(stage(spark, docs, sf_dir), name)
    return docs
