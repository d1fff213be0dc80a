"""Corner values of expressions and predicates."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymark.functions import calendar as cal
from tallymark.functions import predicates as p
from tallymark.functions import sizes, text
from tallymark.functions.flags import differs_or_missing, labelled


def values(spark, rows, kind, expression):
    df = spark.createDataFrame([(n, r) for n, r in enumerate(rows)], f"n int, x {kind}")
    return [r[0] for r in df.orderBy("n").select(expression(F.col("x"))).collect()]


def kept(spark, rows, kind, condition):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.where(condition(F.col("x"))).collect()]


def test_not_in_drops_null(spark):
    assert kept(spark, ["a", "b", None], "string", lambda c: p.outside(c, ["a"])) == ["b"]


def test_missing_prefix_keeps_null_and_is_case_sensitive(spark):
    rows = [None, "ACCT1", "acct1", "VAT1"]
    assert kept(spark, rows, "string", lambda c: p.lacks_prefix_or_null(c, "ACCT")) == [None, "acct1", "VAT1"]
    assert kept(spark, rows, "string", lambda c: p.has_prefix(c, "ACCT")) == ["ACCT1"]


def test_usable_names(spark):
    assert kept(spark, [None, " -", "-", "--", "  Acme"], "string", p.named) == ["  Acme"]


def test_recent_window_includes_its_first_day(spark):
    rows = [dt.datetime(2024, 1, 1), dt.datetime(2023, 12, 31, 23, 59)]
    assert kept(spark, rows, "timestamp_ntz", lambda c: p.since(c, dt.date(2024, 6, 29), 180)) == rows[:1]


def test_monitored_tables(spark):
    rows = ["Control", "WarningX", "my_warning", "EquipoPreventaX", "Historico_A", "HistoricoB", "x_Historico_"]
    assert kept(spark, rows, "string", p.monitored_table) == ["Control", "HistoricoB", "x_Historico_"]


def test_user_relations(spark):
    rows = [
        ("public", "r"), ("pg_catalog", "r"), ("information_schema", "v"),
        ("pg_toast_12", "t"), ("my_pg_toast", "r"), ("public", "i"), (None, "r"),
    ]
    df = spark.createDataFrame(rows, "s string, k string")
    found = df.where(p.user_relation(F.col("s"), F.col("k"))).collect()
    assert [tuple(r) for r in found] == [("public", "r"), ("my_pg_toast", "r")]


def test_negated_conjunction_is_three_valued(spark):
    rows = [(True, True), (True, None), (False, None), (None, None)]
    df = spark.createDataFrame(rows, "a boolean, b boolean")
    assert [r[0] for r in df.select(p.not_both(F.col("a"), F.col("b"))).collect()] == [False, None, True, None]


def test_service_label_keeps_trailing_space(spark):
    rows = ["Fiber Instance #3", "Fiber #3", "Fiber", None]
    assert values(spark, rows, "string", text.service_label) == ["Fiber ", "Fiber ", "Fiber", None]


def test_last_segment(spark):
    assert values(spark, ["a.b.Holding", "Holding", None], "string", text.last_segment) == ["Holding", "Holding", None]


def test_plain_status(spark):
    rows = [
        "abc6#9BBB59$Active", "Active", "a b6#9BBB59$Active",
        "q6#F5DF48$Pending Activation", None, "x[_]6#9BBB59$Active",
    ]
    expected = ["Active", None, "a Active", "Pending Activation", None, "Active"]
    assert values(spark, rows, "string", text.plain_status) == expected
    assert values(spark, rows[:2], "string", text.decorated) == [True, False]


def test_type_label_passes_unknown_ids_through(spark):
    rows = [9145485386913639390, 9145485386913639391, 9145485386913639400, 9145485386913639392, None]
    expected = ["Holding", "Customer Country", "Legal Entity", "9145485386913639392", None]
    assert values(spark, rows, "long", text.type_label) == expected


def test_replace_at(spark):
    assert values(spark, ["abc"], "string", lambda c: text.replace_at(c, 1)) == ["ac"]
    assert values(spark, ["abc"], "string", lambda c: text.replace_at(c, 0, "X")) == ["Xbc"]
    assert values(spark, ["abc"], "string", lambda c: text.replace_at(c, 2, "X")) == ["abX"]


def test_decode_and_clean(spark):
    rows = [bytearray(b"a\xffb\x01\xc3\xa9\x7f\tc"), None]
    cleaned = values(spark, rows, "binary", lambda c: text.printable(text.decoded(c)))
    assert cleaned == ["abé\tc", None]
    assert values(spark, ["x😀y"], "string", text.printable) == ["x😀y"]


def test_flags_of_missing_ids(spark):
    rows = [(None, None), (None, "x"), ("x", "x"), ("x", "y")]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = F.col("a"), F.col("b")
    found = df.select(
        labelled(differs_or_missing(a, b), ("Yes", "No")), labelled(a == b, ("Yes", "No"))
    ).collect()
    assert [tuple(r) for r in found] == [("Yes", "No"), ("Yes", "No"), ("No", "Yes"), ("Yes", "No")]


def test_synthetic_seconds_and_back(spark):
    assert values(spark, [dt.datetime(1970, 1, 1)], "timestamp_ntz", cal.synthetic_seconds) == [62125920000.0]
    assert values(spark, [62125920000, 62167219200, 62167219199], "long", cal.epoch_minus_years) == [
        dt.datetime(1968, 1, 1), dt.datetime(1970, 1, 1), dt.datetime(1969, 1, 1),
    ]


def test_instant_is_a_true_conversion(spark):
    assert values(spark, [86400], "long", lambda c: cal.instant(c).cast("timestamp_ntz")) == [dt.datetime(1970, 1, 2)]


@pytest.mark.parametrize(
    "day, aware, plain",
    [
        (dt.date(2024, 1, 8), dt.date(2024, 1, 5), dt.date(2024, 1, 7)),
        (dt.date(2024, 1, 7), dt.date(2024, 1, 6), dt.date(2024, 1, 6)),
        (dt.date(2024, 1, 9), dt.date(2024, 1, 8), dt.date(2024, 1, 8)),
    ],
)
def test_previous_run_day(spark, day, aware, plain):
    assert values(spark, [day], "date", lambda c: cal.previous_run_day(c, True)) == [aware]
    assert values(spark, [day], "date", lambda c: cal.previous_run_day(c, False)) == [plain]


def test_day_texts(spark):
    assert values(spark, [dt.date(2024, 3, 5)], "date", cal.iso_day) == ["2024-03-05"]
    assert values(spark, [dt.date(2024, 3, 5)], "date", cal.short_day) == ["5/3/2024"]


def test_size_units(spark):
    rows = ["12 kB", "3 MB", "2 GB", "5000 bytes", "1 TB", "3000 MB", "2097152 kB", None]
    assert values(spark, rows, "string", sizes.size_in_kb) == [12, 3072, 2097152, 4, 1073741824, 3072000, 2097152, None]
    assert values(spark, rows, "string", sizes.size_in_gb) == [0, 0, 2, 0, 1024, 2, 2, None]


def test_pretty_size(spark):
    rows = [0, 10239, 10240, 10 * 1024 * 1024, -10240, 1536 * 1024, 20 * 1024**4, None]
    expected = ["0 bytes", "10239 bytes", "10 kB", "10 MB", "-10 kB", "1536 kB", "20 TB", None]
    assert values(spark, rows, "long", sizes.pretty_size) == expected
    # Half a unit rounds away from zero.
    assert values(spark, [20 * 1024 + 512, 20 * 1024 + 511], "long", sizes.pretty_size) == ["21 kB", "20 kB"]
