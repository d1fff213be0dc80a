"""Joins, versions, keys, drift and table maintenance against hand-made rows."""

from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators import drift, matching, shape, tables, versions
from tallymark.operators.keys import dense_keys, next_key

slow = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
small_key = st.one_of(st.none(), st.integers(0, 4))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_keys_of_different_types_match_as_text(spark):
    left = frame(spark, [(1, "a"), (2, "b")], "id long, x string")
    right = frame(spark, [("1", 10), ("not-a-number", 11)], "ext string, y int")
    assert rows(matching.match_inner(left, right, "id", "ext")) == Counter([(1, "a", "1", 10)])
    assert rows(matching.match_anti(right, left, "ext", "id")) == Counter([("not-a-number", 11)])


def test_overlapping_columns_are_refused(spark):
    df = frame(spark, [(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="rename"):
        matching.match_inner(df, df, "a", "b")


def test_self_join_by_role(spark):
    edges = frame(spark, [(1, 2), (2, 3)], "parent int, child int")
    joined = matching.match_inner(
        shape.with_role(edges, "R1"), shape.with_role(edges, "R2"), "child_R1", "parent_R2"
    )
    assert rows(joined) == Counter([(1, 2, 2, 3)])


def test_one_frame_on_both_sides(spark):
    df = frame(spark, [(1, 2), (2, 3)], "parent int, child int")
    assert rows(matching.match_semi(df, df, "child", "parent")) == Counter([(1, 2)])
    assert rows(matching.match_anti(df, df, "parent", "child")) == Counter([(1, 2)])
    renamed = shape.with_role(df, "x")
    assert rows(matching.match_hot(df, renamed, "child", "parent_x", hot=[2])) == Counter([(1, 2, 2, 3)])


def test_null_left_keys(spark):
    left = frame(spark, [(None, 1), (1, 2), (2, 3)], "k int, n int")
    right = frame(spark, [(1,), (None,)], "r int")
    assert rows(matching.match_anti(left, right, "k", "r")) == Counter([(None, 1), (2, 3)])
    assert rows(matching.match_semi(left, right, "k", "r")) == Counter([(1, 2)])
    assert rows(matching.match_left(left, right, "k", "r")) == Counter(
        [(None, 1, None), (1, 2, 1), (2, 3, None)]
    )


def test_anti_where_looks_at_matching_right_rows_only(spark):
    left = frame(spark, [(1,), (2,)], "k int")
    right = frame(spark, [(1, 7), (2, 8)], "r int, kind int")
    assert rows(matching.match_anti_where(left, right, "k", "r", "kind", 7)) == Counter([(2,)])


def test_differs(spark):
    left = frame(spark, [(1,), (2,), (None,)], "k int")

    def kept(right):
        return rows(matching.match_differs(left, frame(spark, right, "r int"), "k", "r"))

    assert kept([(1,), (1,)]) == Counter([(2,)])
    assert kept([(1,), (2,)]) == Counter([(1,), (2,)])
    assert kept([]) == Counter()
    assert kept([(None,)]) == Counter()


@slow
@given(st.lists(small_key, max_size=8), st.lists(st.tuples(small_key, small_key), max_size=8))
def test_either_equals_the_or_join(spark, left, right):
    a = frame(spark, [(k, n) for n, k in enumerate(left)], "k int, n int")
    b = frame(spark, [(x, y, n) for n, (x, y) in enumerate(right)], "x int, y int, m int")
    plain = a.join(b, (a.k == b.x) | (a.k == b.y))
    assert rows(matching.match_either(a, b, "k", "x", "y")) == rows(plain)


@slow
@given(st.lists(small_key, max_size=8), st.lists(small_key, max_size=8))
def test_differs_equals_the_inequality_join(spark, left, right):
    a, b = frame(spark, [(k,) for k in left], "k int"), frame(spark, [(k,) for k in right], "r int")
    assert rows(matching.match_differs(a, b, "k", "r")) == rows(a.join(b, a.k != b.r, "left_semi"))


@slow
@given(st.lists(small_key, max_size=12), st.lists(small_key, max_size=8), st.sampled_from(["inner", "left"]))
def test_hot_join_equals_the_plain_join(spark, left, right, how):
    a = frame(spark, [(k, n) for n, k in enumerate(left)], "k int, n int")
    b = frame(spark, [(k, n) for n, k in enumerate(right)], "r int, m int")
    got = matching.match_hot(a, b, "k", "r", how, hot=[0, None, 3], salts=4)
    assert rows(got) == rows(a.join(b, a.k == b.r, how))


@slow
@given(st.lists(small_key, max_size=12), st.lists(small_key, max_size=8))
def test_hot_anti_join_equals_the_plain_one(spark, left, right):
    a = frame(spark, [(k, n) for n, k in enumerate(left)], "k int, n int")
    b = frame(spark, [(k,) for k in right], "r int")
    assert rows(matching.match_anti(a, b, "k", "r", hot=[0, None])) == rows(a.join(b, a.k == b.r, "left_anti"))
    as_text = b.select(F.col("r").cast("string").alias("r"))
    assert rows(matching.match_anti(a, as_text, "k", "r", hot=[0])) == rows(a.join(b, a.k == b.r, "left_anti"))


def test_hot_join_across_types(spark):
    a = frame(spark, [(1, n) for n in range(9)] + [(2, 9)], "k long, n int")
    b = frame(spark, [("1", "one"), ("2", "two"), ("x", "none")], "r string, m string")
    got = matching.match_hot(a, b, "k", "r")
    assert rows(got) == Counter([(1, n, "1", "one") for n in range(9)] + [(2, 9, "2", "two")])


def test_hot_keys_are_found(spark):
    third = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    assert matching.hot_keys(third, "k") == [-1]
    assert matching.hot_keys(spark.range(9000), "id") == []
    assert matching.hot_keys(spark.range(0), "id") == []
    nulls = third.select(F.when(F.col("k") > 0, F.col("k")).alias("k"))
    assert matching.hot_keys(nulls, "k") == [None]


def test_hot_rows_are_spread(spark):
    third = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    other = frame(spark, [(-1, "hot"), (4, "cold")], "r long, m string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = matching.match_hot(third, other, "k", "r").withColumn("task", F.spark_partition_id())
        per_task = joined.where("k = -1").groupBy("task").count().collect()
        assert len(per_task) == 4 and sum(r[1] for r in per_task) == 3000
        kept = matching.match_anti(third, other.where("r = 4"), "k", "r", hot=[-1]).withColumn("task", F.spark_partition_id())
        per_task = kept.where("k = -1").groupBy("task").count().collect()
        assert len(per_task) == 4 and sum(r[1] for r in per_task) == 3000
        nulls = spark.range(4000).select(F.lit(None).cast("long").alias("k"), "id")
        kept = matching.match_hot(nulls, other, "k", "r", "left").withColumn("task", F.spark_partition_id())
        per_task = kept.groupBy("task").count().collect()
        assert len(per_task) == 4 and sum(r[1] for r in per_task) == 4000
        kept = matching.match_anti(nulls, other, "k", "r").withColumn("task", F.spark_partition_id())
        per_task = kept.groupBy("task").count().collect()
        assert len(per_task) == 4 and sum(r[1] for r in per_task) == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_version_groups_nulls(spark):
    data = [("a", None, 1), ("a", None, 3), ("a", "x", 2)]
    df = frame(spark, data, "name string, tax string, ts int")
    got = versions.latest_version(df, ["name", "tax"], "ts", "newest")
    assert rows(got) == Counter([("a", None, 3), ("a", "x", 2)])


def test_on_both_sides_ignores_unknown(spark):
    data = [(1, "in"), (1, "out"), (2, "in"), (2, None), (3, "out"), (3, None), (4, None)]
    df = frame(spark, data, "id int, code string")
    member = F.col("code").isin("in")
    got = versions.on_both_sides(df, "id", member)
    inside, outside = df.where(member), df.where(~member)
    semi = inside.join(outside, inside.id == outside.id, "left_semi").select("id").distinct()
    assert rows(got) == rows(semi) == Counter([(1,)])


def test_next_key(spark):
    assert next_key(frame(spark, [], "run_key long"), "run_key").first()[0] == 0
    assert next_key(frame(spark, [(41,), (3,)], "run_key long"), "run_key").first()[0] == 42


def test_dense_keys(spark):
    df = frame(spark, [("c", 1), ("a", 2), ("b", 3)], "pk string, n int")
    assert rows(dense_keys(df, ["pk"], "key", 42)) == Counter([("a", 2, 42), ("b", 3, 43), ("c", 1, 44)])
    many = dense_keys(spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5000).alias("id")), ["id"], "key", 10, 6)
    assert many.where(F.col("key") != F.col("id") + 10).count() == 0
    assert many.select("key").distinct().count() == 5000
    assert dense_keys(frame(spark, [], "pk string"), ["pk"], "key", 0).count() == 0


def test_drift_codes(spark):
    one = frame(spark, [(1, "a")], "x int, y string")
    added = drift.drift_union(one, frame(spark, [(1, "a", 1.0, True)], "x int, y string, z double, w boolean"))
    assert (added.code, added.added, added.removed) == (1, ["z", "w"], [])
    removed = drift.drift_union(one, frame(spark, [(1,)], "x int"))
    assert (removed.code, removed.removed) == (2, ["y"])
    both = drift.drift_union(one, frame(spark, [(1, 2.0)], "x int, z double"))
    assert both.code == 3 and both.frame.columns == ["x", "y", "z"]
    assert rows(both.frame) == Counter([(1, "a", None), (1, None, 2.0)])
    assert drift.drift_union(one, one).code == 0


def test_drift_widens_clashing_types_to_text(spark):
    first = frame(spark, [(1, 1)], "`a.b` int, n int")
    second = frame(spark, [("x", 2**40)], "`a.b` string, n long")
    got = drift.drift_union(first, second).frame
    assert dict(got.dtypes) == {"a.b": "string", "n": "bigint"}
    assert rows(got) == Counter([("1", 1), ("x", 2**40)])


def test_drift_merges_nested_records(spark):
    first = spark.sql("SELECT named_struct('a', 1) AS r")
    second = spark.sql("SELECT named_struct('b', 'x') AS r")
    got = drift.drift_union(first, second).frame
    assert sorted(got.schema["r"].dataType.fieldNames()) == ["a", "b"]
    mixed = drift.drift_union(first, spark.sql("SELECT 'plain' AS r")).frame
    assert rows(mixed) == Counter([('{"a":1}',), ("plain",)])


def test_drift_over_many_frames(spark):
    frames = [frame(spark, [(1,)], "a int"), frame(spark, [(2,)], "b int"), frame(spark, [(3,)], "a int")]
    total, steps = drift.drift_union_all(frames)
    assert [s.code for s in steps] == [3, 2]
    assert rows(total) == Counter([(1, None), (None, 2), (3, None)])


def test_drift_by_day(spark):
    presence = [(1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "a"), (3, "b"), (3, "c")]
    got = drift.drift_by_day(frame(spark, presence, "day int, col string"), "day", "col").orderBy("day").collect()
    assert [tuple(r) for r in got] == [(1, [], [], 0), (2, ["c"], ["b"], 3), (3, [], [], 0)]


def test_run_columns_are_dropped_only_where_present(spark):
    df = frame(spark, [(1, 2, 3, 4)], "a int, row_count int, control_type int, Fecha int")
    assert shape.without_run_columns(df).columns == ["a"]


def test_shape_helpers(spark):
    df = frame(spark, [(1, "b")], "`x.y` int, a string")
    assert shape.sorted_columns(df).columns == ["a", "x.y"]
    assert shape.column_types(shape.as_text(df, "x.y"))["x.y"] == "string"
    assert shape.column_types(shape.with_null(df, "n", "date"))["n"] == "date"
    assert shape.to_layout(df, {"a": "max(a)"}).columns == ["max(a)"]
    assert shape.first_values(df).columns == ["x.y"]


def test_delete_keeps_rows_without_a_key(spark):
    df = frame(spark, [(1,), (2,), (None,)], "k long")
    assert rows(tables.without_run(df, "k", 2)) == Counter([(1,), (None,)])


def test_insert_by_name_and_position(spark):
    df = frame(spark, [(1, "a")], "x int, y string")
    assert rows(tables.rows_for_insert(df, ["y", "x"])) == Counter([("a", 1)])
    assert tables.rows_for_insert(df, ["p", "q"], by_position=True).columns == ["p", "q"]


def test_violations(spark):
    results = frame(spark, [(1, "a"), (None, "b"), (9, "c")], "run_key long, x string")
    log = frame(spark, [(1,), (2,)], "run_key long")
    assert rows(tables.violations(results, log, "run_key")) == Counter(
        [(None, "b", "null key"), (9, "c", "unknown run")]
    )


def test_conform_orders_and_casts(spark):
    schema = T.StructType([T.StructField("b", T.StringType()), T.StructField("a", T.LongType())])
    got = tables.conform(frame(spark, [(1, 2)], "a int, b int"), schema)
    assert got.dtypes == [("b", "string"), ("a", "bigint")]
