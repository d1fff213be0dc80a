"""Publishing, reports and monitoring."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.plans.control import Control, Target
from tallymark.plans.operations import Operations, dataset_size_history
from tallymark.runs import monitoring, publish, reports
from tallymark.session import new_work_path
from tallymark.sinks.stores import CatalogStore, FolderStore, NamedStore, NamedTable

NOON = dt.datetime(2024, 5, 2, 12)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def store(spark):
    made = FolderStore(spark, new_work_path(spark, "store"), {"results": "run_key"})
    publish.create_run_tables(made)
    return made


def test_first_run_has_key_zero_and_counts_rows(spark, store):
    results = spark.createDataFrame([(1, 5, 9), (2, 6, 9)], "x int, row_count int, control_type int")
    assert publish.publish_run(store, results, "results", 52, attribute_keys=[11, 2], run_ts=NOON) == 0
    assert publish.publish_run(store, results.limit(1), "results", 52, row_count=70) == 1
    stored = store.read("results")
    assert sorted(stored.columns) == ["run_key", "x"]
    assert rows(stored.select("x", F.col("run_key").cast("int"))) == Counter([(1, 0), (2, 0), (1, 1)])
    log = store.read(publish.RUN_LOG).orderBy("run_key").collect()
    assert [(r.run_key, r.control_type, r.row_count, r.attribute_keys) for r in log] == [
        (0, 52, 2, [11, 2]), (1, 52, 70, None),
    ]
    assert log[0].run_ts == NOON


def test_an_empty_result_is_a_run_too(spark, store):
    empty = spark.createDataFrame([], "x int")
    assert publish.publish_run(store, empty, "plain", 54) == 0
    assert store.read(publish.RUN_LOG).first().row_count == 0


def test_a_broken_run_stays_hidden_and_its_key_is_not_reused(spark, store):
    bad = spark.createDataFrame([("x",)], "s string").select(F.col("s").cast("int").alias("n"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        publish.publish_run(store, bad, "results", 52)
    assert store.read(publish.RUN_LOG).count() == 0
    assert publish.publish_run(store, spark.range(3), "results", 52) == 1


def test_rows_that_do_not_arrive_keep_the_run_hidden(spark):
    class Lossy(FolderStore):
        def append(self, df, table):
            super().append(df.where("id > 0") if table == "results" else df, table)

    store = Lossy(spark, new_work_path(spark, "store"))
    publish.create_run_tables(store)
    with pytest.raises(publish.IncompleteWrite):
        publish.publish_run(store, spark.range(3), "results", 52)
    assert store.read(publish.RUN_LOG).count() == 0


def test_one_run_per_row(spark, store):
    publish.publish_run(store, spark.range(1), "other", 1)
    results = spark.createDataFrame([("b", 7), ("a", 8)], "pk string, attribute_key int")
    assert publish.publish_rows(store, results, "rows", 66, ["pk"], NOON) == 1
    assert rows(store.read("rows").select("pk", "run_key")) == Counter([("a", 1), ("b", 2)])
    log = store.read(publish.RUN_LOG).where("control_type = 66")
    assert rows(log.select("run_key", "attribute_key", "row_count")) == Counter([(1, 8, None), (2, 7, None)])
    assert publish.publish_run(store, spark.range(1), "other", 1) == 3
    assert publish.publish_rows(store, results.limit(0), "rows", 66, ["pk"]) == -1


def test_status_event(spark, store):
    publish.publish_status(store, False, "MyControl")
    assert rows(store.read(publish.STATUS_HISTORY).select("status", "control")) == Counter([("NOK", "MyControl")])
    assert store.read(publish.RUN_LOG).first().control_type == fv.CONTROL_TYPES["run_status"]


def test_catalog_store(spark):
    database = "store_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    try:
        catalog = CatalogStore(spark, database, {"results": "run_key"})
        catalog.append(spark.createDataFrame([(1, 0), (2, 1)], "x int, run_key int"), "results")
        catalog.append(spark.createDataFrame([(2, 9)], "run_key int, x int"), "results")
        assert rows(catalog.read("results").select("x", "run_key")) == Counter([(1, 0), (2, 1), (9, 2)])
        catalog.create("results", publish.RUN_CLAIM_SCHEMA)
        catalog.drop_run("results", 1)
        assert rows(catalog.read("results").select("x", "run_key")) == Counter([(1, 0), (9, 2)])
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_a_control_publishes_each_result(spark, store):
    class Two(Control):
        targets = {"a": Target("a_table", 1, (4,)), "b": Target("b_table", 2)}

        def compute(self):
            return {"a": spark.range(2), "b": spark.range(3)}

    assert Two().publish(store, NOON) == {"a": 0, "b": 1}
    assert rows(store.read(publish.RUN_LOG).select("control_type", "row_count")) == Counter([(1, 2), (2, 3)])


def test_tables_under_the_names_in_use(spark):
    folder = FolderStore(spark, new_work_path(spark, "store"))
    store = NamedStore(
        folder,
        {
            publish.RUN_LOG: NamedTable("RunTable", fv.RUN_LOG_COLUMNS),
            publish.STATUS_HISTORY: NamedTable("StatusTable", fv.STATUS_COLUMNS),
        },
    )
    publish.create_run_tables(store)
    publish.create_run_tables(store)
    publish.publish_status(store, True, "MyControl", NOON)
    written = folder.read("StatusTable")
    assert sorted(written.columns) == ["ClEjecControl", "ControlName", "OKNOK"]
    log_row = folder.read("RunTable").first()
    assert (log_row.ClEjecControl, log_row.ClTipControl, log_row.NumRegistros, log_row.Fecha) == (0, 39, 1, NOON)
    report = reports.full_history(store.read(publish.STATUS_HISTORY), store.read(publish.RUN_LOG), ["control"])
    assert rows(report.select("status", "control", "run_day")) == Counter([("OK", "MyControl", NOON.date())])


def log(spark, data):
    return spark.createDataFrame(data, "run_key long, run_ts timestamp_ntz")


def test_reports(spark):
    results = spark.createDataFrame([("b", 1), ("a", 2), ("c", 2), ("d", None)], "x string, run_key long")
    runs = log(spark, [(1, dt.datetime(2024, 1, 1, 5)), (2, dt.datetime(2024, 6, 30, 5))])
    latest = reports.latest_report(results, runs, ["x"]).collect()
    assert [tuple(r) for r in latest] == [("a", 2, dt.date(2024, 6, 30)), ("c", 2, dt.date(2024, 6, 30))]
    assert [r.x for r in reports.full_history(results, runs, [F.desc("x")]).collect()] == ["c", "b", "a"]
    unnamed = results.union(spark.createDataFrame([(None, 1)], results.schema))
    assert [r.x for r in reports.full_history(unnamed, runs, ["x"]).collect()] == ["a", "b", "c", None]
    recent = reports.recent_history(results, runs, dt.date(2024, 7, 1), ["x"])
    assert [r.x for r in recent.collect()] == ["a", "c"]
    unlogged = reports.latest_report(results, log(spark, [(1, NOON)]), ["x"])
    assert [r.run_key for r in unlogged.collect()] == [1]


def test_latest_report_reads_one_partition(spark, store):
    for n in range(3):
        publish.publish_run(store, spark.range(n + 1), "results", 1, run_ts=NOON)
    latest = reports.of_latest_run(store.read("results"))
    assert latest.count() == 3
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_key" in plan


def test_dashboard_sql_over_views(spark, store):
    for n in (2, 3):
        publish.publish_run(store, spark.range(n), "results", 1, run_ts=NOON)
    reports.register_views(store, ["results", publish.RUN_LOG])
    got = spark.sql(
        """SELECT t.*, date(r.run_ts) AS run_day FROM results t JOIN run_log r ON t.run_key = r.run_key
        WHERE t.run_key = (SELECT max(run_key) FROM results) ORDER BY t.id"""
    )
    report = reports.latest_report(store.read("results"), store.read(publish.RUN_LOG), ["id"])
    assert got.collect() == report.collect() and got.count() == 3


def test_run_status(spark):
    controls = spark.createDataFrame([("never",), ("yesterday",), ("today",), ("warning_x",)], "control string")
    days = spark.createDataFrame(
        [("yesterday", dt.date(2024, 5, 1)), ("today", dt.date(2024, 5, 1)), ("today", dt.date(2024, 5, 2))],
        "control string, day date",
    )
    assert rows(monitoring.run_status(controls, days, dt.date(2024, 5, 2))) == Counter(
        [("NOK", "never"), ("NOK", "yesterday"), ("OK", "today")]
    )
    assert rows(monitoring.run_status(controls, days, dt.date(2024, 5, 2), first_run=True)) == Counter(
        [("NOK", "never"), ("OK", "yesterday"), ("OK", "today"), ("OK", "today")]
    )


def test_operations(spark, store):
    runs = log(spark, [(1, NOON), (2, NOON - dt.timedelta(days=1))])
    tables = {
        "ran": spark.createDataFrame([(1,), (2,)], "run_key int"),
        "late": spark.createDataFrame([(2,)], "run_key int"),
        "unlogged": spark.createDataFrame([(9,)], "run_key int"),
        "Historico_x": spark.createDataFrame([(1,)], "run_key int"),
        "no_key": spark.range(1),
    }
    relations = spark.createDataFrame(
        [("res", "ran", "r", 3 * 1024**3), ("res", "late", "r", 5000), ("res", "ix", "i", 1024), ("pg_catalog", "ran", "r", 1)],
        "schema string, relation string, kind string, bytes long",
    )
    got = Operations(tables, runs, relations, "res", NOON.date()).compute()
    assert rows(got["run_status"]) == Counter([("OK", "ran"), ("NOK", "late"), ("NOK", "unlogged")])
    assert rows(got["schema_size"]) == Counter([(3,)])
    assert rows(got["table_size"]) == Counter([("3072 MB", 3145728, "ran"), ("5000 bytes", 4, "late")])
    empty = spark.createDataFrame([], publish.STATUS_SCHEMA)
    first = Operations(tables, runs, relations, "res", NOON.date(), empty).compute()["run_status"]
    assert rows(first) == Counter([("OK", "ran"), ("OK", "ran"), ("OK", "late"), ("NOK", "unlogged")])
    keys = Operations(tables, runs, relations, "res", NOON.date()).publish(store, NOON)
    assert sorted(keys.values()) == [0, 1, 2]


def test_dataset_size_history(spark, tmp_path):
    datasets = spark.createDataFrame([("n", "i", "SPICE", 5)], "Name string, Id string, ImportMode string, Size long")
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    datasets.withColumn("Fecha", F.lit("1/5/2024")).write.option("header", True).csv(first)
    got = dataset_size_history(spark, datasets, dt.date(2024, 5, 2), first, second)
    assert rows(got) == Counter([("n", "i", "SPICE", 5, "2/5/2024"), ("n", "i", "SPICE", 5, "1/5/2024")])
    with pytest.raises(ValueError, match="overwrite"):
        dataset_size_history(spark, datasets, dt.date(2024, 5, 2), first, first + "/")


def test_a_broken_last_run_does_not_hide_the_last_good_one(spark):
    results = spark.createDataFrame([(1, "good"), (2, "broken")], "run_key long, name string")
    log = spark.createDataFrame([(1, dt.datetime(2024, 3, 1))], "run_key long, run_ts timestamp")
    assert [r.name for r in reports.latest_report(results, log, ["name"]).collect()] == ["good"]
