"""Sides stored in buckets give the joins' rows, without moving what lies in buckets."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tallymark.checks import control_queries
from tallymark.operators import matching
from tallymark.plans.reconciliation import StoredReconciliation
from tallymark.runs import publish
from tallymark.session import new_work_path
from tallymark.sinks.match_tables import MatchTables, match_anti_stored, match_stored
from tallymark.sinks.stores import FolderStore


def side(spark, rows, key, value):
    tables = MatchTables(spark, f"side_{uuid.uuid4().hex}", [key], buckets=4)
    df = spark.createDataFrame(rows, f"{key} string, {value} long")
    tables.refresh(df)
    return df, tables.read()


def bag(df):
    return sorted(map(repr, df.collect()))


HOT = [("hot", n) for n in range(300)]
LONE = [("lone", n) for n in range(300)]
PLAIN = [(f"k{n}", n) for n in range(200)] + [(None, n) for n in range(500)]


@pytest.mark.parametrize(
    "left, right",
    [
        (PLAIN, PLAIN[::3]),
        (HOT + LONE + PLAIN, [("hot", -1), ("hot", -2), *PLAIN[::2]]),
        ([("hot", -1), *PLAIN[::2]], HOT + LONE + PLAIN),
        (HOT + PLAIN, [("hot", n) for n in range(100)] + PLAIN[:40]),
        ([], PLAIN),
        (PLAIN, []),
    ],
)
def test_rows_of_plain_joins(spark, left, right):
    a, stored_a = side(spark, left, "a", "x")
    b, stored_b = side(spark, right, "b", "y")
    assert bag(match_stored(stored_a, stored_b, "a", "b")) == bag(matching.match_inner(a, b, "a", "b"))
    assert bag(match_anti_stored(stored_a, stored_b, "a", "b")) == bag(matching.match_anti(a, b, "a", "b"))
    assert bag(stored_a.rows()) == bag(a)


def test_hot_and_null_keys_stay_out_of_buckets(spark):
    _, stored = side(spark, HOT + PLAIN, "a", "x")
    assert stored.hot("a") == ["hot"] and stored.unkeyed("a").count() == 500
    assert stored.dealt("a").where("a is null or a = 'hot'").count() == 0


def test_sides_that_do_not_fit(spark):
    _, few = side(spark, PLAIN, "a", "x")
    other = MatchTables(spark, f"side_{uuid.uuid4().hex}", ["b"], buckets=8)
    other.refresh(spark.createDataFrame([("k1", 1)], "b string, y long"))
    with pytest.raises(ValueError, match="buckets"):
        match_stored(few, other.read(), "a", "b")
    numbers = MatchTables(spark, f"side_{uuid.uuid4().hex}", ["b"], buckets=4)
    numbers.refresh(spark.createDataFrame([(1, 1)], "b long, y long"))
    with pytest.raises(ValueError, match="type"):
        match_stored(few, numbers.read(), "a", "b")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_on_either_side(spark, sf_dir, no_broadcast):
    stored = StoredReconciliation.tables(spark, f"recon_{uuid.uuid4().hex}", buckets=4)
    stored.refresh(control_queries._reconciliation(spark, sf_dir))
    results = stored.compute()
    for name in ("matched_by_global_id", "crm_only", "account_only"):  # no key of these is hot
        assert "SortMergeJoin" in plan_of(results[name]) and "Exchange" not in plan_of(results[name]), name
    # some external ids are hot in so small a table, and only their rows move
    crm, accounts = stored.crm.read(), stored.accounts.read()
    assert crm.hot("crm_ext_id") and "Exchange" in plan_of(results["matched_by_external_id"])
    dealt = plan_of(matching.match_inner(crm.dealt("crm_ext_id"), accounts.dealt("OBJECT_ID"), "crm_ext_id", "OBJECT_ID"))
    assert "SortMergeJoin" in dealt and "Exchange" not in dealt


def test_a_reader_keeps_its_version(spark):
    tables = MatchTables(spark, f"side_{uuid.uuid4().hex}", ["a"], buckets=4)
    tables.refresh(spark.createDataFrame(PLAIN, "a string, x long"))
    before = tables.read()
    broken = spark.createDataFrame([("1", 1)], "a string, x long").withColumn("a", F.raise_error(F.lit("midway")).cast("string"))
    with pytest.raises(Exception, match="midway"):
        tables.refresh(broken)
    assert tables.read().version == before.version
    tables.refresh(spark.createDataFrame([("new", 1)], "a string, x long"))
    assert before.rows().count() == len(PLAIN) and tables.read().rows().count() == 1


def test_published_like_the_plain_control(spark, sf_dir):
    prepared = control_queries._reconciliation(spark, sf_dir)
    stored = StoredReconciliation.tables(spark, f"recon_{uuid.uuid4().hex}", buckets=4)
    stored.refresh(prepared)
    store = FolderStore(spark, new_work_path(spark, "store"), {name: "run_key" for name in stored.targets})
    publish.create_run_tables(store)
    keys = stored.publish(store)
    for name, result in prepared.compute().items():
        rows = store.read(name).where(F.col("run_key") == keys[name]).drop("run_key")
        assert bag(rows.select(*sorted(rows.columns))) == bag(result.select(*sorted(result.columns))), name
