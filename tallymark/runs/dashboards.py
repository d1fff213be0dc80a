"""The dashboards as SQL: flags as SQL functions, reports as statements with named parameters.

For users who read results with SQL only. The statements say what reports.py and
`report_flags` say with DataFrames, and Catalyst plans both alike: SQL functions are taken
into the statement, parameters are constants.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallymark import fixed_values as fv
from tallymark.runs.reports import REPORT_DAYS

FUNCTIONS = (
    """CREATE OR REPLACE TEMPORARY FUNCTION flag_label(holds BOOLEAN, yes STRING, no STRING) RETURNS STRING
    RETURN CASE WHEN holds THEN yes ELSE no END""",
    """CREATE OR REPLACE TEMPORARY FUNCTION differs_or_missing(a STRING, b STRING) RETURNS BOOLEAN
    RETURN a <> b OR a IS NULL OR b IS NULL""",
    """CREATE OR REPLACE TEMPORARY FUNCTION within_days(run_ts TIMESTAMP, as_of DATE, days INT) RETURNS BOOLEAN
    RETURN run_ts >= date_sub(as_of, days)""",
)

RECONCILIATION_FLAGS = """
    flag_label(differs_or_missing(r.crm_ext_id, r.OBJECT_ID), :R1_1_yes, :R1_1_no) AS R1_1,
    flag_label(r.crm_ext_id = r.OBJECT_ID, :R1_2_yes, :R1_2_no) AS R1_2,
    flag_label(r.NameSF <> r.NAME, :R1_3_yes, :R1_3_no) AS R1_3,
    flag_label(r.record_type <> r.CUST_TYPE, :R1_4_yes, :R1_4_no) AS R1_4,
    flag_label(startswith(r.TAX_IDENT_NUMBER, :prefix), 'Yes', 'No') AS has_flag"""

# Only runs in the log count; the latest of them is a scalar, so its partition alone is read.
LATEST = """
SELECT r.*, CAST(l.run_ts AS DATE) AS run_day{flags}
FROM {{results}} r JOIN {{run_log}} l ON r.run_key = l.run_key
WHERE r.run_key = (SELECT max(k.run_key) FROM (SELECT DISTINCT run_key FROM {{results}}) k WHERE k.run_key IN (SELECT run_key FROM {{run_log}}))
ORDER BY {order} ASC NULLS LAST"""

HISTORY = """
SELECT r.*, CAST(l.run_ts AS DATE) AS run_day{flags}
FROM {{results}} r JOIN {{run_log}} l ON r.run_key = l.run_key
ORDER BY {order} ASC NULLS LAST"""

RECENT = """
SELECT r.*, CAST(l.run_ts AS DATE) AS run_day
FROM {results} r JOIN {run_log} l ON r.run_key = l.run_key AND within_days(l.run_ts, :as_of, :days)
ORDER BY run_day ASC"""

SCHEMA_SIZES = """
SELECT DISTINCT CAST(r.size_gb AS INT) AS size_gb, CAST(l.run_ts AS DATE) AS run_day
FROM {results} r JOIN {run_log} l ON r.run_key = l.run_key AND within_days(l.run_ts, :as_of, :days)
ORDER BY run_day ASC"""


class Dashboards:
    """The dashboards' statements in a session."""

    def __init__(self, spark: SparkSession, labels: Mapping[str, tuple] = fv.REPORT_LABELS, prefix: str = fv.FLAG_PREFIX):
        self.spark = spark
        self.flag_values = {"prefix": prefix}
        for name, (yes, no) in labels.items():
            self.flag_values |= {f"{name}_yes": str(yes), f"{name}_no": str(no)}
        for statement in FUNCTIONS:
            spark.sql(statement)

    def _flagged(self, statement: str, results: DataFrame, run_log: DataFrame, order: str, flags: bool) -> DataFrame:
        text = statement.format(flags="," + RECONCILIATION_FLAGS if flags else "", order=f"r.`{order.replace('`', '``')}`")
        return self.spark.sql(text, args=self.flag_values if flags else {}, results=results, run_log=run_log)

    def latest(self, results: DataFrame, run_log: DataFrame, order: str = "NAME", flags: bool = True) -> DataFrame:
        """Rows of the latest run that the log holds, with the flags of a reconciliation."""
        return self._flagged(LATEST, results, run_log, order, flags)

    def history(self, results: DataFrame, run_log: DataFrame, order: str = "NAME", flags: bool = True) -> DataFrame:
        return self._flagged(HISTORY, results, run_log, order, flags)

    def recent(self, results: DataFrame, run_log: DataFrame, as_of: dt.date, days: int = REPORT_DAYS) -> DataFrame:
        return self.spark.sql(RECENT, args={"as_of": as_of, "days": days}, results=results, run_log=run_log)

    def schema_sizes(self, sizes: DataFrame, run_log: DataFrame, as_of: dt.date, days: int = REPORT_DAYS) -> DataFrame:
        return self.spark.sql(SCHEMA_SIZES, args={"as_of": as_of, "days": days}, results=sizes, run_log=run_log)
