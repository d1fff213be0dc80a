"""One night from inputs to reports, each control reading what the one before published."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tallymark import fixed_values as fv
from tallymark.checks import inputs as i
from tallymark.plans.customer_flags import CustomerFlags
from tallymark.plans.hierarchy import Holding
from tallymark.plans.operations import Operations
from tallymark.plans.reconciliation import Reconciliation, report_flags
from tallymark.runs import publish, reports
from tallymark.session import new_work_path
from tallymark.sinks.stores import FolderStore

NIGHT = dt.datetime(2024, 5, 2, 3, 3)


def test_two_nights(spark, sf_dir):
    controls = ["holding", *Reconciliation.targets, *CustomerFlags.targets]
    store = FolderStore(spark, new_work_path(spark, "store"), {name: "run_key" for name in controls})
    publish.create_run_tables(store)
    accounts, versions = i.accounts(spark, sf_dir), i.account_versions(spark, sf_dir)
    for night in (NIGHT - dt.timedelta(days=1), NIGHT):
        Holding(
            accounts, i.relations(spark, sf_dir), i.types(spark), i.PARENT_OF, i.TYPE_IDS
        ).publish(store, night)
        Reconciliation(
            versions, i.crm(spark, sf_dir), i.services(spark, sf_dir), i.orders(spark, sf_dir),
            store.read("holding"), i.TYPE_LABELS, run_log=store.read(publish.RUN_LOG),
        ).publish(store, night)
    CustomerFlags(accounts, i.services(spark, sf_dir), i.FLAG_CODES).publish(store, NIGHT)

    log = store.read(publish.RUN_LOG)
    assert log.count() == 2 * (1 + 4) + 3
    assert sorted(r[0] for r in log.select("run_key").collect()) == list(range(13))
    by_type = {r.control_type: r for r in log.orderBy("run_key").collect()}
    assert set(by_type) == {fv.CONTROL_TYPES[name] for name in controls}

    latest = reports.latest_report(store.read("matched_by_global_id"), log, ["NAME"])
    row = by_type[fv.CONTROL_TYPES["matched_by_global_id"]]
    assert latest.count() == row.row_count and row.attribute_keys == fv.RECONCILIATION_ATTRIBUTES
    assert [r[0] for r in latest.select("run_day").distinct().collect()] == [NIGHT.date()]
    names = [r.NAME for r in latest.collect()]
    assert names == sorted(names, key=lambda n: (n is None, n or ""))
    assert {"R1_1", "R1_2", "R1_3", "R1_4", "has_flag"} <= set(report_flags(latest).columns)
    history = reports.full_history(store.read("matched_by_global_id"), log, ["NAME"])
    assert history.count() == 2 * latest.count()
    recent = reports.recent_history(store.read("shared_customers"), log, NIGHT.date(), ["run_day"])
    assert recent.count() == by_type[fv.CONTROL_TYPES["shared_customers"]].row_count

    relations = spark.createDataFrame(
        [("results", name, "r", 2048) for name in controls],
        "schema string, relation string, kind string, bytes long",
    )
    tables = {name: store.read(name) for name in controls}
    status = Operations(tables, log, relations, "results", NIGHT.date()).compute()["run_status"]
    assert {tuple(r) for r in status.collect()} == {("OK", name) for name in controls}
    late = Operations(tables, log, relations, "results", NIGHT.date() + dt.timedelta(days=1)).compute()
    assert late["run_status"].where(F.col("status") == "OK").count() == 0
