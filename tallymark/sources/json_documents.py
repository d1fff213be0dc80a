"""Daily JSON documents `{"records": [...]}` below `<base>/<year>/<month>/<day>/`.

Records are taken out of a document as JSON text first, so no schema is needed
to split it and every later step works on one record per row. A document is
the smallest unit a task reads; days and tables are read in parallel.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.text import decoded, printable
from tallymark.operators.drift import drift_by_day
from tallymark.session import new_work_path

# A broken document or a value that does not fit its type fails the job.
PARSE_OPTIONS = {"allowUnquotedControlChars": "true", "mode": "FAILFAST"}
DAY_PATTERN = r"/(\d{4})/(\d{1,2})/(\d{1,2})/[^/]+$"


def day_path(base: str, table: str, day: dt.date) -> str:
    """Month and day are not zero-padded."""
    return f"{base.rstrip('/')}/{day.year}/{day.month}/{day.day}/{table}.json"


def days_back(as_of: dt.date, days: int) -> list[dt.date]:
    """`as_of` minus days-1 up to the day before: days-1 days, today excluded."""
    return [as_of - dt.timedelta(days=n) for n in range(days - 1, 0, -1)]


def read_document(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Records of documents, one row each; a broken document fails the job."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    if schema is not None:
        wanted = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        reader = reader.schema(T.StructType([T.StructField("records", T.ArrayType(wanted))]))
    return reader.json(path).select(F.explode(_present("records")).alias("r")).select("r.*")


def _present(records: Column | str) -> Column:
    return F.coalesce(records, F.raise_error(F.lit("document without records")))


def record_texts(documents: DataFrame, content: Column, *keep: str) -> DataFrame:
    """One JSON text per record of each document, next to the columns kept.

    A truncated document, or one without `records`, fails the job.
    """
    parsed = F.from_json(content, "records array<string>", PARSE_OPTIONS)
    return documents.select(*keep, F.explode(_present(parsed["records"])).alias("record"))


def read_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Record texts of documents that may hold stray bytes, with their path.

    Undecodable bytes and unprintable characters are dropped before parsing.
    """
    files = spark.read.format("binaryFile").load(paths)
    return record_texts(files.select("path", "content"), printable(decoded(F.col("content"))), "path")


def written_records(records: DataFrame, *keep: str) -> str:
    """Write record texts one per line to the shared folder and return the path.

    A document cannot be split between tasks, its written records can.
    """
    path = new_work_path(records.sparkSession, "records")
    writer = records.select(*keep, F.col("record").alias("value")).write
    (writer.partitionBy(*keep) if keep else writer).text(path)
    return path


def typed_records(
    records: DataFrame, schema: T.StructType | str, *keep: str
) -> DataFrame:
    """Record texts as columns of a known schema; a value of another type fails the job."""
    parsed = records.select(*keep, F.from_json("record", schema, PARSE_OPTIONS).alias("r"))
    return parsed.select(*keep, "r.*")


def inferred_records(spark: SparkSession, path: str) -> DataFrame:
    """Written records as columns, with the schema inferred over all of them."""
    return spark.read.options(**PARSE_OPTIONS).json(path)


def path_day(path: Column) -> Column:
    """Day named by the folders of a document's path."""
    year, month, day = (F.regexp_extract(path, DAY_PATTERN, i).cast("int") for i in (1, 2, 3))
    return F.make_date(year, month, day)


def column_presence(records: DataFrame, day: str) -> DataFrame:
    """One row per day and field seen in any record of that day."""
    fields = F.explode(F.json_object_keys("record")).alias("column")
    return records.select(day, fields).distinct()


def read_days(
    spark: SparkSession,
    base: str,
    table: str,
    days: int,
    as_of: dt.datetime,
    schema: T.StructType | str | None = None,
    stamp: str = "Fecha",
) -> tuple[DataFrame, DataFrame]:
    """Records of the last days with their day, and the drift per day.

    All days are read in one job; fields missing on a day are null, a field
    with different types over the days is widened to text. The stamp keeps the
    time of day of `as_of`.
    """
    if days < 2:
        raise ValueError("days counts today, which is not read: give at least 2")
    paths = [day_path(base, table, day) for day in days_back(as_of.date(), days)]
    texts = read_records(spark, paths).select(path_day(F.col("path")).alias("_day"), "record")
    path = written_records(texts, "_day")
    records = spark.read.text(path).select(F.col("value").alias("record"), F.col("_day").cast("date"))
    drift = drift_by_day(column_presence(records, "_day"), "_day", "column")
    frame = inferred_records(spark, path) if schema is None else typed_records(records, schema, "_day")
    age = F.datediff(F.lit(as_of.date()), F.col("_day").cast("date"))
    stamped = frame.withColumn(stamp, F.lit(as_of) - F.make_dt_interval(age))
    return stamped.drop("_day"), drift
