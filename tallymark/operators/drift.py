"""Union of extracts whose columns change from day to day."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.predicates import quoted
from tallymark.operators.shape import sorted_columns

UNCHANGED, ADDED, REMOVED, BOTH = 0, 1, 2, 3


class DriftUnion(NamedTuple):
    frame: DataFrame
    code: int
    added: list[str]
    removed: list[str]


def drift_code(added: Sequence, removed: Sequence) -> int:
    return (ADDED if added else UNCHANGED) + (REMOVED if removed else UNCHANGED)


def _same_family(first: T.DataType, second: T.DataType) -> bool:
    if first == second or isinstance(first, T.NullType) or isinstance(second, T.NullType):
        return True
    for family in (T.NumericType, T.StructType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(first, family) and isinstance(second, family):
            return True
    return False


def _text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    def as_text(name: str):
        if isinstance(df.schema[name].dataType, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(quoted(name))
        return quoted(name).cast("string")

    return df.withColumns({name: as_text(name) for name in names}) if names else df


def drift_union(known: DataFrame, new: DataFrame) -> DriftUnion:
    """Union by name; a column missing on one side is null there.

    Columns come out in name order. A column whose types cannot be combined is
    widened to text on both sides. Fields of nested records are combined too.
    """
    added = [c for c in new.columns if c not in known.columns]
    removed = [c for c in known.columns if c not in new.columns]
    clashing = [
        c
        for c in known.columns
        if c in new.columns and not _same_family(known.schema[c].dataType, new.schema[c].dataType)
    ]
    frame = _text(known, clashing).unionByName(_text(new, clashing), allowMissingColumns=True)
    return DriftUnion(sorted_columns(frame), drift_code(added, removed), added, removed)


def drift_union_all(frames: Sequence[DataFrame]) -> tuple[DataFrame, list[DriftUnion]]:
    """Union of many frames with the drift found at each step."""
    total, steps = frames[0], []
    for frame in frames[1:]:
        step = drift_union(total, frame)
        total = step.frame
        steps.append(step)
    return sorted_columns(total), steps


def snapshot_union(new: DataFrame, history: DataFrame) -> DataFrame:
    """New rows ahead of the history, columns aligned by name."""
    return new.unionByName(history, allowMissingColumns=True)


def drift_by_day(presence: DataFrame, day: str, column: str) -> DataFrame:
    """Added and removed columns of each day against all days before it.

    `presence` holds one row per day and column present that day. Only the list
    of days goes into one row; columns are grouped each by itself. A column is
    added on its first day (not on the first day of all) and removed on each
    later day it is absent.
    """
    pairs = presence.select(quoted(day).alias("day"), quoted(column).alias("column"))
    days = pairs.agg(F.array_sort(F.collect_set("day")).alias("days")).scalar()
    seen = pairs.groupBy("column").agg(F.collect_set("day").alias("present"), F.min("day").alias("first"))
    seen = seen.withColumn("days", days)
    absent = F.array_except(F.filter("days", lambda d: d > F.col("first")), F.col("present"))
    added = seen.where(F.col("first") > F.col("days")[0]).select(
        F.col("first").alias("day"), F.col("column").alias("new"), F.lit(None).cast("string").alias("gone")
    )
    removed = seen.select(
        F.explode(absent).alias("day"), F.lit(None).cast("string").alias("new"), F.col("column").alias("gone")
    )
    changes = added.union(removed).groupBy("day").agg(
        F.array_sort(F.collect_list("new")).alias("added"), F.array_sort(F.collect_list("gone")).alias("removed")
    )
    none = F.array().cast("array<string>")
    report = pairs.select("day").distinct().join(changes, "day", "left").select(
        "day", F.coalesce("added", none).alias("added"), F.coalesce("removed", none).alias("removed")
    )
    code = F.when(F.size("added") > 0, ADDED).otherwise(UNCHANGED) + F.when(
        F.size("removed") > 0, REMOVED
    ).otherwise(UNCHANGED)
    return report.withColumn("code", code)
