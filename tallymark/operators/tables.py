"""Maintenance of result tables, expressed on their rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.predicates import quoted
from tallymark.operators.matching import match_anti


def rows_for_insert(source: DataFrame, target_columns: Sequence[str], by_position: bool = False) -> DataFrame:
    """Rows of one table version in the column order of another.

    By name unless the caller knows that only the position agrees.
    """
    if by_position:
        return source.toDF(*target_columns)
    return source.select(*map(quoted, target_columns))


def joined_table(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """Rows for a table made from two tables.

    `columns` maps each output column to `left.name` or `right.name`, since a
    name may exist on both sides.
    """
    left, right = left.alias("left"), right.alias("right")
    joined = left.join(right, F.col(f"left.`{left_key}`") == F.col(f"right.`{right_key}`"))
    picked = []
    for output, source in columns.items():
        side, name = source.split(".", 1)
        picked.append(F.col(f"{side}.`{name}`").alias(output))
    return joined.select(*picked)


def add_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Typed nullable columns at the end."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})


def without_run(df: DataFrame, key: str, value: int) -> DataFrame:
    """All rows but those of one run; rows without a key stay."""
    return df.where(~quoted(key).eqNullSafe(F.lit(value)))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns, order and types of a fixed table layout."""
    return df.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in schema])


def orphans(results: DataFrame, run_log: DataFrame, key: str, log_key: str | None = None) -> DataFrame:
    """Result rows whose run key is missing from the run log."""
    return match_anti(results, run_log, key, log_key or key)


def violations(results: DataFrame, run_log: DataFrame, key: str, log_key: str | None = None) -> DataFrame:
    """Rows breaking the table's constraints, with the reason."""
    missing = results.where(quoted(key).isNull()).withColumn("reason", F.lit("null key"))
    unknown = orphans(results.where(quoted(key).isNotNull()), run_log, key, log_key)
    return missing.unionByName(unknown.withColumn("reason", F.lit("unknown run")))
