"""Dashboards in SQL give what the DataFrame reports give; bounds of rules and of hot keys."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallymark.operators import exception_rules, matching
from tallymark.plans import reconciliation as recon
from tallymark.runs import reports
from tallymark.runs.dashboards import Dashboards

COLUMNS = "run_key long, NAME string, NameSF string, OBJECT_ID string, crm_ext_id string, CUST_TYPE string, record_type string, TAX_IDENT_NUMBER string"
RUNS = [(1, dt.datetime(2001, 1, 1, 5)), (2, dt.datetime(2001, 7, 30, 5)), (3, dt.datetime(2001, 8, 1, 5))]


@pytest.fixture(scope="module")
def results(spark):
    rows = [
        (k, *row)
        for k in (1, 2, 3, 4)  # the fourth broke off before its log row
        for row in [
            ("A", "A", "1", "1", "H", "H", "ACCT1"),
            ("B", None, "2", None, "H", "L", None),
            (None, "C", None, None, None, "L", "VACCT"),
            ("O'D", "O", "4", "5", "H", None, "ACC"),
        ]
    ]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(RUNS, "run_key long, run_ts timestamp")


def same(first, second):
    columns = sorted(first.columns)
    assert columns == sorted(second.columns)
    assert dict(first.dtypes) == dict(second.dtypes)
    got, want = ([tuple(r) for r in df.select(*columns).collect()] for df in (first, second))
    assert Counter(got) == Counter(want) and got
    return [r.NAME for r in first.collect()] if "NAME" in columns else None


def test_reports_agree(spark, results, log):
    sql = Dashboards(spark)
    names = same(sql.latest(results, log), recon.report_flags(reports.latest_report(results, log, ["NAME"])))
    assert names == ["A", "B", "O'D", None]
    names = same(sql.history(results, log), recon.report_flags(reports.full_history(results, log, ["NAME"])))
    assert names == sorted(names, key=lambda n: (n is None, n or "")) and len(names) == 12
    as_of = dt.date(2001, 8, 1)
    same(sql.recent(results, log, as_of), reports.recent_history(results, log, as_of, ["run_day"]))
    sizes = log.select("run_key", F.lit(7).alias("size_gb"))
    same(sql.schema_sizes(sizes, log, as_of), reports.recent_schema_sizes(sizes, log, as_of))


def test_other_labels_and_plain_reports(spark, results, log):
    sql = Dashboards(spark, {f"R1_{n}": ("it's", ":no") for n in range(1, 5)}, prefix="VACC")
    flags = {tuple(r) for r in sql.latest(results, log).select("R1_1", "has_flag").collect()}
    assert flags == {("it's", "No"), ("it's", "Yes"), (":no", "No")}
    plain = Dashboards(spark).latest(results, log, "NameSF", flags=False)
    assert plain.columns == [*results.columns, "run_day"]
    assert Dashboards(spark).latest(results.limit(0), log).count() == 0


def test_the_latest_run_is_read_alone(spark, results, log, tmp_path):
    results.write.partitionBy("run_key").parquet(str(tmp_path / "r"))
    stored = spark.read.schema(results.schema).parquet(str(tmp_path / "r"))
    plan = Dashboards(spark).latest(stored, log)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_key" in plan and "Subquery" in plan


def test_rules_turn_to_a_table_beyond_the_bound(spark, monkeypatch):
    df = spark.createDataFrame([(i, i % 7 or None, 0) for i in range(60)], "id int, k int, isDuplicate int")
    rules = spark.createDataFrame([("k", str(n), None, None) for n in range(3)] + [("id", str(n), "k", "5") for n in range(4)], "attr1 string, val1 string, attr2 string, val2 string")

    def both():
        return Counter(exception_rules.suppress(df, rules).collect()), Counter(exception_rules.mark_duplicates(df, rules).collect())

    inlined = both()
    assert "Join" not in exception_rules.suppress(df, rules)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(exception_rules, "FEW_RULES", 6)
    assert both() == inlined
    assert "Join" in exception_rules.suppress(df, rules)._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="more than 6"):
        exception_rules.suppress(df, rules, inline=True)


def test_hot_keys_follow_the_number_of_partitions(spark):
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 100 == 0, -1).otherwise(F.col("id")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert matching.hot_share(spark) == matching.HOT_SHARE and matching.hot_keys(rows, "k") == []
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        assert matching.hot_share(spark) == 200 and matching.hot_keys(rows, "k") == [-1]
        spark.conf.set("spark.sql.shuffle.partitions", "100000")
        assert matching.hot_share(spark) == matching.MOST_SHARES
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_holdings_need_their_log(spark):
    with pytest.raises(ValueError, match="log of their runs"):
        frame = spark.createDataFrame([], "NAME string, TAX_IDENT_NUMBER string, PARENT_ID long, UNIQUE_GLOBAL_ID string, STATUS string, OBJECT_ID long, CUST_TYPE long, MODIFIED_WHEN timestamp")
        recon.Reconciliation(frame, None, None, None, holdings=frame)
