"""Monitoring: did every control run today, and how large are the tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.predicates import monitored_table, quoted, user_relation
from tallymark.functions.sizes import pretty_size, size_in_gb, size_in_kb

EPOCH = dt.date(1970, 1, 1)


def result_run_keys(results: Mapping[str, DataFrame], key: str = "run_key") -> DataFrame:
    """Distinct (control, run key) over all result tables that carry the key."""
    parts = [
        df.select(quoted(key).cast("long").alias("run_key")).distinct().select(F.lit(name).alias("control"), "run_key")
        for name, df in results.items()
        if key in df.columns
    ]
    return reduce(DataFrame.unionByName, parts)


def run_days(run_keys: DataFrame, run_log: DataFrame, run_ts: str = "run_ts") -> DataFrame:
    """Distinct days on which each control ran."""
    runs = run_log.select("run_key", quoted(run_ts).cast("date").alias("day"))
    return run_keys.join(runs, "run_key").select("control", "day").distinct()


def day_bitmaps(days: DataFrame) -> DataFrame:
    """(control, span, days): the days on which a control ran, a bit each.

    A row holds 32,768 days, some ninety years of 4 kB, however often the control ran.
    """
    number = F.datediff("day", F.lit(EPOCH)) + 1
    keyed = days.select("control", F.bitmap_bucket_number(number).alias("span"), F.bitmap_bit_position(number).alias("bit"))
    return keyed.groupBy("control", "span").agg(F.bitmap_construct_agg("bit").alias("days"))


def merged_bitmaps(*bitmaps: DataFrame) -> DataFrame:
    """The days of all; a night adds its own to those before, a repeated day changes nothing."""
    return reduce(DataFrame.unionByName, bitmaps).groupBy("control", "span").agg(F.bitmap_or_agg("days").alias("days"))


def days_run(bitmaps: DataFrame) -> DataFrame:
    """Number of days on which each control ran."""
    return bitmaps.groupBy("control").agg(F.sum(F.bitmap_count("days")).alias("n_days"))


def missed_days(bitmaps: DataFrame, first: Column | dt.date, last: Column | dt.date, weekdays: bool = False) -> DataFrame:
    """(control, day) of the days from `first` to `last` on which a control has no run.

    Read off one row per control and span: no join with the run log. `weekdays` leaves out
    Saturdays and Sundays. A span without a row has no run at all.
    """
    wanted = F.sequence(*(F.lit(day) if isinstance(day, dt.date) else day for day in (first, last)))
    spans = bitmaps.groupBy("control").agg(F.map_from_entries(F.collect_list(F.struct("span", "days"))).alias("spans"))
    rows = spans.select("control", "spans", F.explode(wanted).alias("day"))
    number = F.datediff("day", F.lit(EPOCH)) + 1
    bit = F.bitmap_bit_position(number)
    held = F.conv(F.hex(F.substring(F.try_element_at("spans", F.bitmap_bucket_number(number)), 1 + (bit / 8).cast("int"), F.lit(1))), 16, 10)
    ran = held.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
    rows = rows.withColumn("bit", bit).where(~F.coalesce(ran, F.lit(False)))
    return rows.where(F.weekday("day") < 5 if weekdays else F.lit(True)).select("control", "day")


def run_status(
    controls: DataFrame, days: DataFrame, as_of: dt.date, first_run: bool = False
) -> DataFrame:
    """OK for each control that ran on `as_of`, else NOK.

    `first_run` fills an empty status history: one OK row per day a control
    has run, NOK where it never has.
    """
    wanted = controls.where(monitored_table(F.col("control"))).select("control").distinct()
    if first_run:
        joined = wanted.join(days, "control", "left")
        return joined.select(F.when(F.col("day").isNull(), "NOK").otherwise("OK").alias("status"), "control")
    today = days.groupBy("control").agg(F.bool_or(F.col("day") == F.lit(as_of)).alias("ran"))
    joined = wanted.join(today, "control", "left")
    return joined.select(
        F.when(F.coalesce("ran", F.lit(False)), "OK").otherwise("NOK").alias("status"), "control"
    )


def schema_size(relations: DataFrame, schema: str) -> DataFrame:
    """Whole GB held by one schema, from (schema, bytes) rows."""
    total = relations.where(F.col("schema") == schema).groupBy("schema").agg(F.sum("bytes").alias("total"))
    return total.select(size_in_gb(pretty_size(F.col("total"))).alias("size_gb"))


def table_sizes(relations: DataFrame, tables: DataFrame) -> DataFrame:
    """Name, size text and whole kB of each listed table.

    `relations` has (schema, relation, kind, bytes) rows, `tables` has `name`.
    """
    sized = relations.where(user_relation(F.col("schema"), F.col("kind"))).select(
        "relation", pretty_size(F.col("bytes")).alias("size")
    )
    joined = sized.join(tables.select("name"), F.col("relation") == F.col("name"))
    return joined.select("size", size_in_kb(F.col("size")).alias("size_kb"), "name")
