"""Run keys: the next free key and dense consecutive keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted
from tallymark.session import written_once

# monotonically_increasing_id keeps the partition above bit 33.
POSITION_BITS = 33


def next_key(log: DataFrame, key: str) -> DataFrame:
    """One row with max + 1, or 0 for an empty log."""
    return log.agg(F.coalesce(F.max(quoted(key)) + 1, F.lit(0)).cast("long").alias("next_key"))


def dense_keys(
    df: DataFrame, order: Iterable[str], name: str, start: Column | int, partitions: int | None = None
) -> DataFrame:
    """Consecutive keys from `start` in the order of a unique column list.

    A global row_number would sort everything in one task. Here the rows are
    range partitioned and sorted, each row notes partition and position, and
    only the row count of each partition (one row per partition) is summed up
    and sent back. The noted positions are written out once: evaluating the
    range partitioning twice may draw other boundaries. Without `partitions`
    AQE merges small ranges.
    """
    columns = [quoted(c) for c in order]
    ranged = df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    ranged = ranged.sortWithinPartitions(*columns)
    placed = written_once(ranged.withColumn("_place", F.monotonically_increasing_id()), "keys")
    part = F.shiftright(F.col("_place"), POSITION_BITS)
    position = F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    first = F.lit(start) if isinstance(start, int) else start
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (first + F.col("_before") + position).cast("long"))
        .drop("_part", "_before", "_place")
    )
