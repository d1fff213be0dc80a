"""Reports: result rows with the day of their run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.predicates import quoted, since
from tallymark.sinks.stores import Store

REPORT_DAYS = 180


def _latest_key(results: DataFrame, run_log: DataFrame | None, key: str, log_key: str) -> Column:
    """Key of the latest run, of those in the log where one is given; a scalar subquery."""
    if run_log is not None:
        logged = run_log.select(quoted(log_key).alias("_log_key")).distinct()
        keys = results.select(quoted(key)).distinct()
        results = keys.join(logged, quoted(key) == F.col("_log_key"), "left_semi")
    return results.agg(F.max(quoted(key))).scalar()


def of_latest_run(
    results: DataFrame, key: str = "run_key", run_log: DataFrame | None = None, log_key: str = "run_key"
) -> DataFrame:
    """Rows of the latest run in the table; with a run log, of the latest complete run.

    The key is a scalar subquery, so a table partitioned by run reads only
    that run.
    """
    return results.where(quoted(key) == _latest_key(results, run_log, key, log_key))


def with_run_day(
    results: DataFrame,
    run_log: DataFrame,
    key: str = "run_key",
    log_key: str = "run_key",
    run_ts: str = "run_ts",
    day: str = "run_day",
) -> DataFrame:
    """Every result column plus the date of the run; rows of unlogged runs go."""
    runs = run_log.select(quoted(log_key).alias("_log_key"), quoted(run_ts).cast("date").alias("_day"))
    columns = [quoted(c) for c in results.columns if c != day]
    joined = results.join(runs, quoted(key) == F.col("_log_key"))
    return joined.select(*columns, F.col("_day").alias(day))


def _ordered(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Sorted as asked, nulls last for names, as the dashboards' database does.

    Ties are broken by content, so that a frequent value can be split between
    tasks.
    """
    wanted = [quoted(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    return df.orderBy(*wanted, F.xxhash64(*map(quoted, df.columns)))


def latest_report(
    results: DataFrame, run_log: DataFrame, order: Sequence[str | Column], key: str = "run_key", **names: str
) -> DataFrame:
    """Rows of the latest run that the log holds, ordered; a broken later run is passed over.

    All of them share one run key, so a shuffle by key would put them in one
    task. The log is cut down to that run as well: keys are unique in it, so
    this is one row and safe to broadcast.
    """
    log_key = names.get("log_key", "run_key")
    latest = _latest_key(results, run_log, key, log_key)
    one_run = F.broadcast(run_log.where(quoted(log_key) == latest))
    return _ordered(with_run_day(results.where(quoted(key) == latest), one_run, key, **names), order)


def full_history(
    results: DataFrame, run_log: DataFrame, order: Sequence[str | Column], key: str = "run_key", **names: str
) -> DataFrame:
    """Rows of every run, ordered."""
    return _ordered(with_run_day(results, run_log, key, **names), order)


def recent_history(
    results: DataFrame,
    run_log: DataFrame,
    as_of: dt.date,
    order: Sequence[str | Column],
    days: int = REPORT_DAYS,
    key: str = "run_key",
    run_ts: str = "run_ts",
    **names: str,
) -> DataFrame:
    """Rows of the runs of the last days, ordered."""
    recent = run_log.where(since(quoted(run_ts), as_of, days))
    return _ordered(with_run_day(results, recent, key, run_ts=run_ts, **names), order)


def recent_schema_sizes(
    sizes: DataFrame, run_log: DataFrame, as_of: dt.date, size: str = "size_gb", days: int = REPORT_DAYS
) -> DataFrame:
    """Distinct whole sizes per run day of the last days, ordered by day."""
    recent = run_log.where(since(F.col("run_ts"), as_of, days))
    dated = with_run_day(sizes, recent)
    return dated.select(quoted(size).cast("int").alias(size), "run_day").distinct().orderBy("run_day")


def register_views(store: Store, tables: Sequence[str]) -> None:
    """Make result tables and the run log available to `spark.sql` by name."""
    for table in tables:
        store.read(table).createOrReplaceTempView(table)
