"""Both ways of applying rules must agree with SQL's three-valued logic."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymark.operators.exception_rules import mark_duplicates, suppress

RULE = "attr1 string, val1 string, attr2 string, val2 string"
slow = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
cell = st.one_of(st.none(), st.sampled_from(["p", "q"]))
rule = st.one_of(
    st.tuples(st.just("a"), cell, st.none(), st.none()),
    st.tuples(st.sampled_from(["a", "b"]), cell, st.just("b"), cell),
)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def kept(row, rules):
    """Plain-Python statement of: no rule is true or unknown for the row."""

    def compare(x, y):
        return None if x is None or y is None else x == y

    for attr1, val1, attr2, val2 in rules:
        parts = [compare(row[attr1], val1)]
        if attr2 is not None:
            parts.append(compare(row[attr2], val2))
        if not any(part is False for part in parts):
            return False
    return True


@slow
@given(st.lists(st.tuples(cell, cell), max_size=6), st.lists(rule, max_size=4))
def test_suppress_both_ways(spark, data, rules):
    df = spark.createDataFrame([(a, b, n) for n, (a, b) in enumerate(data)], "a string, b string, n int")
    rule_frame = spark.createDataFrame(rules, RULE)
    expected = Counter(
        (a, b, n) for n, (a, b) in enumerate(data) if kept({"a": a, "b": b}, rules)
    )
    assert rows(suppress(df, rule_frame)) == expected
    assert rows(suppress(df, rule_frame, inline=True)) == expected


@slow
@given(st.lists(st.tuples(cell, cell), max_size=6), st.lists(rule, max_size=4))
def test_mark_both_ways(spark, data, rules):
    df = spark.createDataFrame([(a, b, 0) for a, b in data], "a string, b string, isDuplicate int")
    rule_frame = spark.createDataFrame(rules, RULE)

    def hit(row):
        for attr1, val1, attr2, val2 in rules:
            first = val1 is not None and row[attr1] == val1
            if first and (attr2 is None or (val2 is not None and row[attr2] == val2)):
                return 1
        return 0

    expected = Counter((a, b, hit({"a": a, "b": b})) for a, b in data)
    assert rows(mark_duplicates(df, rule_frame)) == expected
    assert rows(mark_duplicates(df, rule_frame, inline=True)) == expected


def test_null_rule_value_drops_everything(spark):
    df = spark.createDataFrame([("p",), ("q",), (None,)], "a string")
    rules = spark.createDataFrame([("a", None, None, None)], RULE)
    assert suppress(df, rules).count() == suppress(df, rules, inline=True).count() == 0


@pytest.mark.parametrize("inline", [False, True])
def test_suppress_is_idempotent_and_compares_as_text(spark, inline):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    rules = spark.createDataFrame([("a", "2", None, None), ("a", "abc", "b", "x")], RULE)
    once = suppress(df, rules, inline)
    assert rows(once) == rows(suppress(once, rules, inline)) == Counter([(1, "x")])


def test_no_rules_change_nothing(spark):
    df = spark.createDataFrame([(1, None)], "a long, isDuplicate int")
    rules = spark.createDataFrame([], RULE)
    assert rows(suppress(df, rules)) == rows(mark_duplicates(df, rules)) == rows(df)


def test_every_marking_rule_counts(spark):
    df = spark.createDataFrame([("p", 0), ("q", 0), ("r", 1)], "a string, isDuplicate int")
    rules = spark.createDataFrame([("a", "p", None, None), ("a", "q", None, None)], RULE)
    assert rows(mark_duplicates(df, rules)) == Counter([("p", 1), ("q", 1), ("r", 1)])


@pytest.mark.parametrize("inline", [False, True])
def test_numeric_rule_values_are_compared_as_text(spark, inline):
    df = spark.createDataFrame([("a", 0), ("5", 0)], "a string, isDuplicate int")
    rules = spark.createDataFrame([("a", 5, None, None), ("a", 5, None, None)], "attr1 string, val1 int, attr2 string, val2 int")
    assert rows(suppress(df, rules, inline)) == Counter([("a", 0)])
    assert rows(mark_duplicates(df, rules, inline=inline)) == Counter([("a", 0), ("5", 1)])
