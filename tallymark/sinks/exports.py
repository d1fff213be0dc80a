"""CSV exports and snapshot history."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.calendar import short_day
from tallymark.operators.drift import snapshot_union
from tallymark.sources.files import read_history

def export_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Append `;` CSV with header; empty text is written as NULL, null stays empty.

    Every file carries the header. `one_file` moves the finished rows to one
    task; the work before that stays parallel.
    """
    out = df.repartition(1) if one_file else df
    (
        out.write.mode("append")
        .option("sep", ";")
        .option("header", True)
        .option("emptyValue", "NULL")
        .option("encoding", "UTF-8")
        .csv(path)
    )


def snapshot(datasets: DataFrame, as_of, stamp: str = "Fecha") -> DataFrame:
    """Name, Id, ImportMode and Size of each data set, stamped with the day."""
    return datasets.select("Name", "Id", "ImportMode", "Size").withColumn(stamp, short_day(F.lit(as_of)))


def refresh_history(spark: SparkSession, new: DataFrame, history_path: str, out_path: str) -> DataFrame:
    """Write new rows plus the history to a new path and return what was written.

    The history is read with the columns of the new rows; lines that do not
    fit are skipped. The path being read is never written.
    """
    if history_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("the new history must not overwrite the one being read")
    history = read_history(spark, history_path, new.schema)
    snapshot_union(new, history).write.option("header", True).option("sep", ",").csv(out_path)
    return read_history(spark, out_path, new.schema)
