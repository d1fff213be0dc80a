"""Drift of nested fields, from schemas that one aggregation finds.

Records are parsed as variants and their schemas merged by Spark while it groups them by
day, combined before the shuffle; no separate inference pass reads the data, and a day of
any size gives one schema text. Only these texts, one a day, come to the driver, where the
schemas are compared field by field. Their size follows the number of different field
names; objects that use ids as names belong into an array first.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.predicates import quoted
from tallymark.operators.drift import drift_code

QUOTED_OR_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")
PLAIN_NAME = re.compile(r"[^\W\d]\w*")
DRIFT_SCHEMA = "day date, code int, added array<string>, removed array<string>, retyped array<string>"


class Difference(NamedTuple):
    """Paths of fields, the outermost one of a subtree; elements of an array are `[]`."""

    added: list[str]
    removed: list[str]
    retyped: list[str]


def day_schemas(records: DataFrame, day: str, record: str = "record") -> DataFrame:
    """(day, schema): the merged schema of each day's JSON texts; a broken text fails the job."""
    parsed = records.select(quoted(day).alias("day"), F.parse_json(quoted(record)).alias("r"))
    return parsed.groupBy("day").agg(F.schema_of_variant_agg("r").alias("schema"))


def schema_of(text: str) -> T.DataType:
    """A variant schema text as a type; objects are structs."""
    return T.DataType.fromDDL(QUOTED_OR_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], text))


def _family(kind: T.DataType) -> str:
    """Numbers of any width are one family, so is every other kind by itself."""
    return "number" if isinstance(kind, T.NumericType) else kind.typeName()


def _named(path: str, name: str) -> str:
    name = name if PLAIN_NAME.fullmatch(name) else f"`{name.replace('`', '``')}`"
    return f"{path}.{name}" if path else name


def difference(known: T.DataType, new: T.DataType, path: str = "") -> Difference:
    """What `new` has more, less and otherwise than `known`, at any depth.

    A field that holds nulls only has no kind and differs from none.
    """
    added, removed, retyped = [], [], []
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        before, after = ({f.name: f.dataType for f in kind} for kind in (known, new))
        added += [_named(path, n) for n in after if n not in before]
        removed += [_named(path, n) for n in before if n not in after]
        inner = [difference(before[n], after[n], _named(path, n)) for n in before if n in after]
    elif isinstance(known, T.ArrayType) and isinstance(new, T.ArrayType):
        inner = [difference(known.elementType, new.elementType, path + "[]")]
    else:
        inner = []
        if not isinstance(known, T.NullType) and not isinstance(new, T.NullType) and _family(known) != _family(new):
            retyped.append(path)
    for found in inner:
        added, removed, retyped = added + found.added, removed + found.removed, retyped + found.retyped
    return Difference(sorted(added), sorted(removed), sorted(retyped))


def combined(known: T.DataType, new: T.DataType) -> T.DataType:
    """All fields of both, at any depth; where kinds differ, the new one unless it is null."""
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        after = {f.name: f.dataType for f in new}
        kinds = {f.name: combined(f.dataType, after[f.name]) if f.name in after else f.dataType for f in known}
        return T.StructType([T.StructField(n, k) for n, k in (after | kinds).items()])
    if isinstance(known, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(combined(known.elementType, new.elementType))
    return known if isinstance(new, T.NullType) else new


def drift_of_schemas(days: Sequence[tuple[dt.date, T.DataType]]) -> list[tuple]:
    """Rows of DRIFT_SCHEMA: each day against all days before it; the first day has no drift.

    A field is added on its first day, removed on each later day that lacks it, and retyped
    on a day on which its kind isn't that of the last day that had it.
    """
    known, rows = None, []
    for day, new in sorted(days, key=lambda d: d[0]):
        found = Difference([], [], []) if known is None else difference(known, new)
        rows.append((day, drift_code(found.added, found.removed), *found))
        known = new if known is None else combined(known, new)
    return rows


def nested_drift(records: DataFrame, day: str, record: str = "record") -> DataFrame:
    """One row per day with the paths of added, removed and retyped fields."""
    found = day_schemas(records, day, record).where("day IS NOT NULL AND schema IS NOT NULL").collect()
    return records.sparkSession.createDataFrame(drift_of_schemas([(r.day, schema_of(r.schema)) for r in found]), DRIFT_SCHEMA)
