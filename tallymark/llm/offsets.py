"""Global offsets from totals of the parts of a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_base(rows: DataFrame, part: str, size: str, base: str) -> DataFrame:
    """Rows with the sum of `size` over all parts before their own.

    One row per part, that is per task that wrote the table, is summed up in
    order and sent to all tasks: 16 bytes a task, whatever the data.
    """
    totals = rows.groupBy(part).agg(F.sum(size).alias("_total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(part, F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias(base))
    return rows.join(F.broadcast(bases), part)
