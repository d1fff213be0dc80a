"""Grouped facts about an entity: counts, latest version, membership."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted


def rows_per(df: DataFrame, keys: Iterable[str], name: str) -> DataFrame:
    """Row count per group; a null key forms its own group."""
    return df.groupBy(*map(quoted, keys)).agg(F.count("*").alias(name))


def latest_version(df: DataFrame, describe: Iterable[str], version: str, name: str | None = None) -> DataFrame:
    """One row per combination of descriptive columns with its latest version.

    Grouping by every descriptive column lets Spark combine versions before
    the shuffle, also when one entity or null key has most of the rows.
    """
    return df.groupBy(*map(quoted, describe)).agg(F.max(quoted(version)).alias(name or version))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*map(quoted, keys)).distinct()


def total_per(df: DataFrame, key: str, amount: str, name: str) -> DataFrame:
    """Sum per group."""
    return df.groupBy(quoted(key)).agg(F.sum(quoted(amount)).alias(name))


def on_both_sides(df: DataFrame, entity: str, member: Column) -> DataFrame:
    """Entities having rows where `member` is true and rows where it is false.

    Unknown membership counts for neither. One aggregate instead of two semi
    joins of the frame with itself.
    """
    return (
        df.groupBy(quoted(entity))
        .agg(F.bool_or(member).alias("_in"), F.bool_or(~member).alias("_out"))
        .where("_in AND _out")
        .select(quoted(entity))
    )
