"""Publish results under a run key.

Order of writes: claim the key, write the results, write the run row. Reports
join the run log, so a run shows only when it is complete; a run that died
half-way leaves a claim, and its key is never given out again. Any number of
publishers may work at once: claims are files that one of them can create
(claims.py).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark import fixed_values as fv
from tallymark.operators.keys import dense_keys, next_key
from tallymark.operators.shape import without_run_columns
from tallymark.runs.claims import claim
from tallymark.sinks.stores import FolderStore, Store

RUN_LOG = "run_log"
RUN_CLAIM = "run_claim"
STATUS_HISTORY = "run_status_history"

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_key", T.LongType(), False),
        T.StructField("attribute_key", T.IntegerType()),
        T.StructField("control_type", T.IntegerType(), False),
        T.StructField("row_count", T.LongType()),
        T.StructField("attribute_keys", T.ArrayType(T.IntegerType())),
        T.StructField("run_ts", T.TimestampType()),
    ]
)
RUN_CLAIM_SCHEMA = T.StructType(
    [
        T.StructField("run_key", T.LongType(), False),
        T.StructField("control_type", T.IntegerType(), False),
    ]
)
STATUS_SCHEMA = T.StructType(
    [T.StructField("status", T.StringType()), T.StructField("control", T.StringType())]
)
RUN_SCHEMAS = {RUN_LOG: RUN_LOG_SCHEMA, RUN_CLAIM: RUN_CLAIM_SCHEMA}


def create_run_tables(store: Store) -> None:
    """Create the run log and the claims where they do not exist yet."""
    for table, schema in RUN_SCHEMAS.items():
        store.create(table, schema)


class IncompleteWrite(RuntimeError):
    """The store does not hold exactly the rows of the run."""


def _claim(store: Store, control_type: int, width: int = 1) -> int:
    """Reserve `width` keys and return the first; the only place keys are made.

    The claim is entered in the claims table as well, where queries and older
    publishers see it: the last key of the range, which is enough for max + 1.
    """
    keys = store.read(RUN_LOG).select("run_key").union(store.read(RUN_CLAIM).select("run_key"))
    least = next_key(keys, "run_key").first()[0]
    first = claim(store.claims(), control_type, width, least)
    store.append(store.spark.createDataFrame([(first + width - 1, control_type)], RUN_CLAIM_SCHEMA), RUN_CLAIM)
    return first


def run_row(
    spark: SparkSession,
    key: int,
    control_type: int,
    row_count: int | None,
    attribute_key: int | None = None,
    attribute_keys: Sequence[int] | None = None,
    run_ts: dt.datetime | None = None,
) -> DataFrame:
    """Run-log row; the time is now unless given."""
    row = (key, attribute_key, control_type, row_count, list(attribute_keys) if attribute_keys else None)
    df = spark.createDataFrame([row], T.StructType(RUN_LOG_SCHEMA.fields[:-1]))
    return df.withColumn("run_ts", F.lit(run_ts) if run_ts else F.current_timestamp())


def _verify(stored: DataFrame, expected: int) -> None:
    found = stored.count()
    if found != expected:
        raise IncompleteWrite(f"{found} rows stored, {expected} written")


def publish_run(
    store: Store,
    results: DataFrame,
    table: str,
    control_type: int,
    attribute_key: int | None = None,
    row_count: int | None = None,
    attribute_keys: Sequence[int] | None = None,
    run_ts: dt.datetime | None = None,
) -> int:
    """One run row for many result rows; returns the run key.

    Rows are counted while they are written, so the results are evaluated
    once. A `row_count` given by the caller goes to the run log instead.
    """
    key = _claim(store, control_type)
    counted = Observation("published")
    tagged = without_run_columns(results).withColumn("run_key", F.lit(key).cast("long"))
    store.append(tagged.observe(counted, F.count(F.lit(1)).alias("n")), table)
    written = counted.get["n"]
    _verify(store.read(table).where(F.col("run_key") == key), written)
    row = run_row(
        store.spark,
        key,
        control_type,
        written if row_count is None else row_count,
        attribute_key,
        attribute_keys,
        run_ts,
    )
    store.append(row, RUN_LOG)
    return key


def publish_rows(
    store: Store,
    results: DataFrame,
    table: str,
    control_type: int,
    order: Sequence[str],
    run_ts: dt.datetime | None = None,
) -> int:
    """One run row per result row; returns the first key.

    Keys follow the order of a unique column list. They are fixed before the
    two writes, which therefore agree on them.
    """
    results = dense_keys(results, order, "_position", 0)
    count = results.count()
    if count == 0:
        return -1
    first = _claim(store, control_type, count)
    keyed = results.withColumn("run_key", F.col("_position") + F.lit(first)).drop("_position")
    optional = {"attribute_key": "int", "row_count": "long"}
    log = keyed.select(
        "run_key",
        *[
            (F.col(c) if c in results.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in optional.items()
        ],
        F.lit(control_type).alias("control_type"),
        F.lit(None).cast("array<int>").alias("attribute_keys"),
        (F.lit(run_ts) if run_ts else F.current_timestamp()).alias("run_ts"),
    ).select(*RUN_LOG_SCHEMA.fieldNames())
    store.append(without_run_columns(keyed), table)
    stored = store.read(table).where(F.col("run_key").between(first, first + count - 1))
    _verify(stored, count)
    store.append(log, RUN_LOG)
    return first


def replace_run(store: FolderStore, results: DataFrame, table: str, key: int) -> int:
    """Put corrected results in the place of a run's, under its key; returns their number.

    The table has to be partitioned by the run key. Other runs' files stay as they are, and
    the run keeps its day; its row count follows when the results are in place.
    """
    log = store.read(RUN_LOG).where(F.col("run_key") == key)
    if log.isEmpty():
        raise ValueError(f"no complete run {key} to replace")
    counted = Observation("replaced")
    tagged = without_run_columns(results).withColumn("run_key", F.lit(key).cast("long"))
    store.replace_run(tagged.observe(counted, F.count(F.lit(1)).alias("n")), table)
    written = counted.get["n"]
    if written == 0:  # an empty frame has no run folder to put in place
        store.drop_run(table, key)
    else:
        _verify(store.read(table).where(F.col("run_key") == key), written)
    store.update(RUN_LOG, F.col("run_key") == key, {"row_count": F.lit(written).cast("long")})
    return written


def publish_status(store: Store, ok: bool, control: str, run_ts: dt.datetime | None = None) -> int:
    """Record that a named control went well or not."""
    row = store.spark.createDataFrame([("OK" if ok else "NOK", control)], STATUS_SCHEMA)
    return publish_run(store, row, STATUS_HISTORY, fv.CONTROL_TYPES["run_status"], run_ts=run_ts)
