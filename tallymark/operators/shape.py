"""Projections, renames, casts and constant columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.functions.predicates import quoted

RUN_LOG_ONLY = ["attribute_key", "row_count", "run_ts", "control_type"]


def pick(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Projection by exact column name."""
    return df.select(*[quoted(c) for c in columns])


def with_role(df: DataFrame, role: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Suffix column names with a role, so both sides of a join stay apart."""
    return df.withColumnsRenamed({c: f"{c}_{role}" for c in (columns or df.columns)})


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by exact, case-sensitive name; others stay."""
    return df.select(*[quoted(c).alias(names.get(c, c)) for c in df.columns])


def to_logical(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename physical columns to logical ones (`names`: logical -> physical)."""
    return renamed(df, {physical: logical for logical, physical in names.items()})


def to_layout(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of a layout (logical -> physical), in its order."""
    return df.select(*[quoted(logical).alias(physical) for logical, physical in layout.items()])


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Cast id columns to string ahead of a key match."""
    return df.withColumns({c: quoted(c).cast("string") for c in columns})


def with_null(df: DataFrame, name: str, type_name: str) -> DataFrame:
    """Typed null column."""
    return df.withColumn(name, F.lit(None).cast(type_name))


def without_run_columns(df: DataFrame) -> DataFrame:
    """Drop run-log columns, where present, before writing results."""
    return df.drop(*RUN_LOG_ONLY, *[fv.RUN_LOG_COLUMNS[c] for c in RUN_LOG_ONLY])


def sorted_columns(df: DataFrame) -> DataFrame:
    """Columns in name order."""
    return pick(df, sorted(df.columns))


def column_types(df: DataFrame) -> dict[str, str]:
    """Type of every column, by name."""
    return dict(df.dtypes)


def preview(df: DataFrame, order: str, n: int, tiebreak: Iterable[str] = ()) -> DataFrame:
    """First `n` rows in a stable order."""
    return df.orderBy(quoted(order), *[quoted(c) for c in tiebreak]).limit(n)


def first_values(df: DataFrame, column: str | None = None) -> DataFrame:
    """One column as a frame, for use in a semi join instead of a driver list."""
    return pick(df, [column or df.columns[0]])
