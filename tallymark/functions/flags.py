"""Yes/no labels of the reconciliation report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def labelled(condition: Column, labels: tuple) -> Column:
    """First label where the condition is true, second where false or unknown."""
    yes, no = labels
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def differs_or_missing(first: Column, second: Column) -> Column:
    """Values differ, or at least one of them is null."""
    return (first != second) | first.isNull() | second.isNull()
