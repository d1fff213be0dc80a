"""Delimited files and parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    schema: T.StructType | str | None = None,
    header: bool = True,
) -> DataFrame:
    """UTF-8 delimited text. Without a schema Spark reads the data once more to infer it."""
    reader = spark.read.option("sep", sep).option("header", header).option("encoding", "UTF-8")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_comma(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return read_delimited(spark, path, ",", schema)


def read_crm_csv(spark: SparkSession, base: str, table: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CRM table kept as `<base>/<table>.csv`."""
    return read_delimited(spark, f"{base.rstrip('/')}/{table}.csv", ";", schema)


def read_crm_parquet(spark: SparkSession, base: str, table: str) -> DataFrame:
    """CRM table kept as `<base>/<table>.parquet`."""
    return spark.read.parquet(f"{base.rstrip('/')}/{table}.parquet")


def read_history(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Comma-separated history without its malformed lines.

    A line with too many fields is skipped. A short line stays, its missing
    fields null, and so does a line with a cell that does not fit its type.
    """
    wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    surplus = T.StructType([*wanted.fields, T.StructField("_surplus", T.StringType())])
    lines = read_delimited(spark, path, ",", surplus)
    return lines.where(F.col("_surplus").isNull()).drop("_surplus")


def dated_pipe_path(base: str, day: str, table: str, prefix: str) -> str:
    """`<base>/<day>/<prefix><day>_<table>.txt`."""
    return f"{base.rstrip('/')}/{day}/{prefix}{day}_{table}.txt"


def column_names(dictionary: DataFrame, table: str) -> list[str]:
    """Names of one table by position, from (table, position, name) rows."""
    rows = dictionary.where(F.col("table") == table).orderBy("position").select("name").collect()
    return [row.name for row in rows]


def read_pipe(
    spark: SparkSession,
    path: str,
    dictionary: DataFrame,
    table: str,
    types: list[str] | None = None,
) -> DataFrame:
    """Headerless pipe-delimited file, columns named by position.

    `types` gives the column types in file order and saves the inference pass.
    """
    schema = ", ".join(f"_c{i} {kind}" for i, kind in enumerate(types)) if types else None
    df = read_delimited(spark, path, "|", schema, header=False)
    names = column_names(dictionary, table)
    if len(names) < len(df.columns):
        raise ValueError(f"{table}: {len(df.columns)} columns, but {len(names)} names")
    return df.toDF(*names[: len(df.columns)])
