"""Every registered query against its SQL twin, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from comparison import connect, spark_multiset, sql_multiset

import __spark_entry__ as entry
from tallymark.checks.registry import ORACLES as TWINS
from tallymark.checks.registry import QUERIES

# Queries of llm have their own tests.
# One-row scalars and the log of a single run are the only broadcasts by hint.
SLOW_PLANS = re.compile("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not SLOW_PLANS.search(plan)
    assert spark_multiset(df) == sql_multiset(duck, TWINS[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
