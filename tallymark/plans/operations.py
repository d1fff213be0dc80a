"""Operations monitoring and the history of data-set sizes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.predicates import monitored_table
from tallymark.plans.control import Control, target
from tallymark.runs.monitoring import result_run_keys, run_days, run_status, schema_size, table_sizes
from tallymark.sinks.exports import refresh_history, snapshot


class Operations(Control):
    """Run status of every result table, size of the schema and of its tables."""

    targets = {name: target(name) for name in ("run_status", "schema_size", "table_size")}

    def __init__(
        self,
        results: Mapping[str, DataFrame],
        run_log: DataFrame,
        relations: DataFrame,
        schema: str,
        as_of: dt.date,
        status_history: DataFrame | None = None,
    ):
        self.results, self.run_log, self.relations = results, run_log, relations
        self.schema, self.as_of = schema, as_of
        self.first_run = status_history is not None and status_history.isEmpty()

    def compute(self) -> dict[str, DataFrame]:
        spark = self.run_log.sparkSession
        keyed = {name: df for name, df in self.results.items() if "run_key" in df.columns}
        controls = spark.createDataFrame([(name,) for name in keyed], "control string")
        # Past days only matter when an empty history is filled.
        today = F.col("run_ts").cast("date") == F.lit(self.as_of)
        log = self.run_log if self.first_run else self.run_log.where(today)
        days = run_days(result_run_keys(keyed), log)
        names = self.relations.where(F.col("schema") == self.schema).select(F.col("relation").alias("name"))
        return {
            "run_status": run_status(
                controls.where(monitored_table(F.col("control"))), days, self.as_of, self.first_run
            ),
            "schema_size": schema_size(self.relations, self.schema),
            "table_size": table_sizes(self.relations, names),
        }


def dataset_size_history(
    spark: SparkSession, datasets: DataFrame, as_of: dt.date, history_path: str, out_path: str
) -> DataFrame:
    """Today's data-set sizes ahead of the history, written to a new path."""
    return refresh_history(spark, snapshot(datasets, as_of), history_path, out_path)
