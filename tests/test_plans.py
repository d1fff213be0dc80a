"""What the plans read, push down and shuffle."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tallymark.checks import inputs as i
from tallymark.operators import exception_rules, matching
from tallymark.plans import customer_flags as flags
from tallymark.plans import hierarchy as tree
from tallymark.plans import reconciliation as recon
from tallymark.session import written_once


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Business tables as they are in use: stored, with all their columns."""
    return {
        "accounts": written_once(i.accounts(spark, sf_dir), "accounts"),
        "services": written_once(i.services(spark, sf_dir), "services"),
        "relations": written_once(i.relations(spark, sf_dir), "relations"),
        "crm": written_once(i.crm(spark, sf_dir), "crm"),
    }


def test_filters_reach_the_scan(stored):
    text = plan(tree.parent_edges(stored["relations"]))
    assert "EqualTo(REL_TYPE,9137799819213569275)" in text
    assert "StringStartsWith(TAX_IDENT_NUMBER,ACCT)" in plan(flags.flagged_accounts(stored["accounts"]))
    assert "EqualTo(STATUS,Active)" in plan(flags.active_services(stored["services"]))
    assert "EqualTo(active,Sí)" in plan(recon.latest_crm(stored["crm"]))


def test_only_needed_columns_are_read(stored):
    text = plan(recon.service_counts(stored["services"]))
    assert re.search(r"ReadSchema: struct<CUSTOMER_ACCOUNT:bigint,STATUS:string>", text)
    text = plan(tree.live_accounts(stored["accounts"]))
    assert "TAX_IDENT_NUMBER" not in text and "ACRONYM" not in text


def test_grouping_combines_before_the_shuffle(stored):
    text = plan(flags.active_services(stored["services"]))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1


def test_counted_activity_is_joined_without_a_further_shuffle(stored, no_broadcast):
    counts = recon.service_counts(stored["services"])
    accounts = stored["accounts"].select(F.col("OBJECT_ID").cast("string").alias("id"))
    assert plan(matching.match_left(accounts, counts, "id", "svc_customer")).count("Exchange") == 2


def test_a_join_without_hot_keys_is_the_plain_join(stored, no_broadcast):
    accounts = stored["accounts"].select("OBJECT_ID")
    text = plan(matching.match_hot(stored["services"].withColumnRenamed("OBJECT_ID", "id"), accounts, "CUSTOMER_ACCOUNT", "OBJECT_ID"))
    assert "_salt" not in text and "Generate" not in text


def test_null_spread_is_a_join_key(stored, no_broadcast):
    text = plan(matching.match_anti(stored["crm"], stored["accounts"], "crm_global_id", "UNIQUE_GLOBAL_ID"))
    assert re.search(r"SortMergeJoin \[_k0#\d+, _spread#\d+L?\], \[_v0#\d+, _spread_r#\d+L?\], LeftAnti", text)


def test_few_rules_add_no_join(spark, stored):
    rules = spark.createDataFrame(i.RULES, i.RULE_SCHEMA)
    assert "Join" not in plan(exception_rules.suppress(stored["accounts"], rules, inline=True))


def test_many_rules_are_one_join_per_pair_of_columns(spark, sf_dir, stored, no_broadcast):
    text = plan(exception_rules.suppress(stored["accounts"], i.part_rules(spark, sf_dir)))
    assert len(re.findall("SortMergeJoin", text)) == 2
