"""Database reads, split over tasks whenever a splitting column is known."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Connection:
    """JDBC address and properties of one database."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Split:
    """Numeric or date column whose range is read in `parts` parallel queries."""

    column: str
    lower: str | int
    upper: str | int
    parts: int


def quoted_table(name: str) -> str:
    """Exact-case table name; a schema may precede it."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def hash_predicates(expression: str, parts: int) -> list[str]:
    """Disjoint conditions that cover every row, null included.

    For keys with a very uneven range, where equal ranges would leave most of
    the rows to one task. `expression` must be an integer.
    """
    rest = [f"MOD(ABS({expression}), {parts}) = {i}" for i in range(1, parts)]
    return [f"(MOD(ABS({expression}), {parts}) = 0 OR ({expression}) IS NULL)"] + rest


def read_relation(
    spark: SparkSession,
    connection: Connection,
    relation: str,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A table name or a parenthesised query with an alias."""
    if predicates:
        return spark.read.jdbc(
            connection.url, relation, predicates=list(predicates), properties=dict(connection.properties)
        )
    reader = spark.read.format("jdbc").option("url", connection.url).option("dbtable", relation)
    reader = reader.options(**connection.properties)
    if split:
        reader = (
            reader.option("partitionColumn", split.column)
            .option("lowerBound", split.lower)
            .option("upperBound", split.upper)
            .option("numPartitions", split.parts)
        )
    return reader.load()


def read_query(
    spark: SparkSession,
    connection: Connection,
    query: str,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a query.

    The query goes in as a derived table, since the reader's own query option
    cannot be combined with a splitting column.
    """
    return read_relation(spark, connection, f"({query}) q", split, predicates)


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    split: Split | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Whole table; Spark pushes column choice and simple filters down."""
    return read_relation(spark, connection, quoted_table(table), split, predicates)


def split_on(spark: SparkSession, connection: Connection, table: str, column: str, parts: int) -> Split | None:
    """Split over the column's actual range, asked of the database in one row."""
    name = f'"{column}"'
    query = f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {quoted_table(table)}"
    row = read_query(spark, connection, query).first()
    if row[0] is None:
        return None
    return Split(name, row[0], row[1], parts)
